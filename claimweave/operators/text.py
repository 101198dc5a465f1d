"""Chunks and sentences as native array expressions: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions import vocab
from claimweave.operators.keyed import items
from claimweave.functions.columns import let, strip

# White space of the Unicode standard and the four ASCII separators.
SENTENCE_BREAK = r"(?U)(?<=[.!?])[\s\x1c-\x1f]+"


def chunks(text: str | Column, size: int = vocab.CHUNK_SIZE, overlap: int = vocab.CHUNK_OVERLAP) -> Column:
    """Overlapping windows over the whole text, stripped, without empty ones.

    A window starts every ``size - overlap`` characters while text is left, so the end of one
    window may come again as a short last chunk.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    text = F.col(text) if isinstance(text, str) else text
    step = size - overlap

    def windows(pieces: Column) -> Column:
        # A window is a piece and as many following ones as it reaches into, the last one cut.
        def window(piece: Column, i: Column) -> Column:
            parts = [piece]
            for k in range(1, -(-size // step)):
                part = F.coalesce(F.get(pieces, i + k), F.lit(""))
                parts.append(F.left(part, F.lit(min(step, size - k * step))))
            return strip(F.concat(*parts))

        return F.transform(pieces, window)

    # The text is cut once, so the cost grows with its length and not with its square.
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    return F.filter(let(pieces, windows), lambda c: c != "")


def chunk_documents(
    docs: DataFrame,
    id_col: str = "paper_id",
    text_col: str = "full_text",
    size: int = vocab.CHUNK_SIZE,
    overlap: int = vocab.CHUNK_OVERLAP,
) -> DataFrame:
    """(id, chunk_id, chunk_index, section, content); the chunk id is ``id:index``."""
    exploded = items(docs, [id_col], chunks(text_col, size, overlap), "chunk_index", "content")
    return exploded.select(
        id_col,
        F.concat_ws(":", F.col(id_col).cast("string"), F.col("chunk_index").cast("string")).alias("chunk_id"),
        "chunk_index",
        F.lit("body").alias("section"),
        "content",
    )


def sentences(text: str | Column) -> Column:
    """Sentences of the whole text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(text, SENTENCE_BREAK, -1)


def sentence_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return items(docs, [id_col], sentences(text_col), "sentence_index", "sentence")
