"""Importance resampling: documents drawn by how much likelier their hashed n-grams are in a target text than in the corpus.

Features of a text are its runs of one to ``grams`` words; a feature's bucket is the CRC-32 of its bytes modulo ``buckets``.
A task takes its texts in slices. The distinct features of a slice are found by numbers (a run is a pair of the shorter run
before it and its last word), each is cut once out of the joined words, and those of equal length form a matrix of bytes whose
CRCs are updated column by column, all features at a time. The buckets then go back to all places of the features. Counts of
buckets leave a task as one row a bucket; gains, again one number a bucket, are the only thing the driver holds and sends out.

Scores take Gumbel noise from a hash of the key, so the highest scores are a draw without replacement by weight, and the same
draw on every cluster. Ranks come from a range partition by score and key: a row's place in its partition plus the sizes of
the partitions before it, so no task sorts more than its share.

Defined cases: a null text has no words; words are runs of ASCII letters and digits and of all characters beyond ASCII; a text
without words has no features and weight 0 and is never drawn; very long texts are read in pieces that share their border
words; rows with one key have one noise and are ranked in any order where their weights agree; a null key counts as the empty
string in the hash and comes last among ties; an empty table gives no rows, an empty target T = 0; further columns are not
read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.session import staged

# Bytes of text worked on at a time.
SLICE = 2 << 20
# Features of more bytes than this, which are few, are hashed one by one.
LONG = 256

# Bytes of words as they are, A-Z in lower case, all others as a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def _crc_table() -> np.ndarray:
    """CRC-32's remainders of single bytes (reflected polynomial 0xEDB88320)."""
    rest = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rest = np.where(rest & 1, (rest >> 1) ^ np.uint32(0xEDB88320), rest >> 1)
    return rest


CRC_TABLE = _crc_table()


def crc_of_spans(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data``: spans of one length form a matrix, whose columns are taken one after the other."""
    bytes_ = np.frombuffer(data, np.uint8)
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)]):
        length, rows = int(lengths[order[a]]), order[a:b]
        if length > LONG:
            out[rows] = [zlib.crc32(data[s : s + length]) for s in starts[rows].tolist()]
            continue
        at_once = max(1, (1 << 22) // max(length, 1))
        for piece in (rows[i : i + at_once] for i in range(0, len(rows), at_once)):
            columns = bytes_[np.arange(length)[:, None] + starts[piece]]
            crc = np.full(len(piece), 0xFFFFFFFF, np.uint32)
            for column in columns:
                crc = CRC_TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
            out[piece] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def feature_buckets(words: list[bytes], texts: np.ndarray, fresh: np.ndarray, grams: int, buckets: int):
    """Text and bucket of every feature that ends in a fresh word.

    ``texts`` holds each word's text, in order. Words that are not fresh were the end of an earlier piece.
    """
    table = dict(zip(dict.fromkeys(words), count()))
    runs = ids = np.fromiter(map(table.__getitem__, words), np.int64, len(words))
    data = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    for size in range(1, grams + 1):
        if size > 1:
            # The runs of this size, by the word they end in: the run before and the last word.
            runs = runs[:-1] * len(table) + ids[size - 1 :]
        if not runs.size:
            return
        first_words, last_words = np.arange(runs.size), np.arange(runs.size) + size - 1
        whole = texts[first_words] == texts[last_words]
        order = np.argsort(runs, kind="stable")
        new = np.diff(runs[order], prepend=-1) != 0
        numbers = np.empty(runs.size, np.int64)
        numbers[order] = np.cumsum(new) - 1
        at = order[new]
        # A run across two texts is no feature; its distinct number is hashed in vain only if no whole run shares it.
        used = np.zeros(at.size, bool)
        used[numbers[whole]] = True
        found = np.zeros(at.size, np.int64)
        found[used] = crc_of_spans(data, starts[at[used]], ends[at[used] + size - 1] - starts[at[used]]) % buckets
        kept = whole & fresh[last_words]
        yield texts[last_words[kept]], found[numbers[kept]]
        runs = numbers


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about SLICE bytes, cut at spaces."""
    text, at = text.translate(WORD_BYTES), 0
    while len(text) - at > 2 * SLICE:
        end = text.find(b" ", at + SLICE)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def _slices(texts: list[bytes | None], grams: int):
    """Words, their texts' places, and which words are fresh, some texts or a piece of one at a time."""
    words, texts_at, fresh, held = [], [], [], 0
    for place, text in enumerate(texts):
        last: list[bytes] = []
        for piece in _pieces(text or b""):
            own = piece.split()
            words += last + own
            texts_at.append((place, len(last) + len(own)))
            fresh.append((False, len(last)))
            fresh.append((True, len(own)))
            last = (last + own)[-(grams - 1) :] if grams > 1 else []
            held += len(piece)
            if held >= SLICE:
                yield words, _runs(texts_at, np.int64), _runs(fresh, bool)
                words, texts_at, fresh, held = [], [], [], 0
    if words:
        yield words, _runs(texts_at, np.int64), _runs(fresh, bool)


def _runs(pairs: list[tuple], kind) -> np.ndarray:
    values, counts = zip(*pairs)
    return np.repeat(np.array(values, kind), counts)


def _count(grams: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for words, texts, fresh in _slices(batch["text"].to_pylist(), grams):
                for _, found in feature_buckets(words, texts, fresh, grams, buckets):
                    totals += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(totals[met])], ["bucket", "n"])

    return run


def _weigh(shared, grams: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = shared.value
        for batch in batches:
            n = batch.num_rows
            n_words, n_features, weights = (np.zeros(n, np.int64) for _ in range(3))
            for words, texts, fresh in _slices(batch["text"].to_pylist(), grams):
                n_words += np.bincount(texts[fresh], minlength=n)
                for at, found in feature_buckets(words, texts, fresh, grams, len(gains)):
                    n_features += np.bincount(at, minlength=n)
                    # Sums of a slice are far below 2^53: exact.
                    weights += np.bincount(at, gains[found], n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["k"], *[pa.array(x) for x in (n_words, n_features, weights)]], ["k", "n_words", "n_features", "weight"]
            )

    return run


def bucket_counts(table: DataFrame, text: str = "text", grams: int = 3, buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    counts = (
        table.select(F.col(text).cast("string").cast("binary").alias("text"))
        .mapInArrow(_count(grams, buckets), "bucket bigint, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    out = np.zeros(buckets, np.int64)
    for row in counts:
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Thousand times the log ratio of a bucket's smoothed shares, rounded down."""
    buckets = len(target)
    of_target, of_source = int(target.sum()) + buckets, int(source.sum()) + buckets
    return np.array(
        [math.floor(1000 * math.log((t + 1) * of_source / ((s + 1) * of_target))) for t, s in zip(target.tolist(), source.tolist())],
        np.int64,
    )


def noise(key: str, seed: str = "42"):
    """Thousandths of Gumbel noise from a hash of the key."""
    of = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(of, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def ranked(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``rank``, 1 for the first in ``order``, by a range partition and the sizes of its parts."""
    placed = staged(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()),
        "ranked",
    ).select("*", F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("row"))
    # One row a partition.
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy("part").count().collect())
    before, offsets = 0, []
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    table = placed.sparkSession.createDataFrame(offsets, "of bigint, before bigint")
    return placed.join(F.broadcast(table), F.col("part") == F.col("of")).select(
        *rows.columns, (F.col("before") + F.col("row") + 1).alias("rank")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    share: tuple[int, int] = (5, 100),
    least_words: int = 20,
    grams: int = 3,
    buckets: int = 10_000,
) -> DataFrame:
    """The key of every row with ``n_words``, ``n_features``, ``weight``, ``score``, and ``rank`` for the drawn ones.

    Drawn is the ``share`` (a fraction of whole numbers, rounded down) of the rows with ``least_words`` words or more that
    has the highest scores.
    """
    gains = bucket_gains(bucket_counts(target, text, grams, buckets), bucket_counts(docs, text, grams, buckets))
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").cast("binary").alias("text"))
    kind = rows.schema["k"].dataType.simpleString()
    scored = staged(
        rows.mapInArrow(_weigh(shared, grams), f"k {kind}, n_words bigint, n_features bigint, weight bigint").withColumn(
            "score", F.col("weight") + noise("k")
        ),
        "scored",
    )
    fit = scored.where(F.col("n_words") >= least_words)
    drawn = fit.count() * share[0] // share[1]
    places = ranked(fit, F.desc("score"), F.asc_nulls_last("k")).withColumn("rank", F.expr(f"if(rank <= {drawn}L, rank, NULL)"))
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return places.unionByName(others).withColumnRenamed("k", key)
