"""Claims from text: word rules, parsed model replies, and a hook for a model."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.functions import vocab
from claimweave.functions.columns import contains_any, let
from claimweave.functions.schemas import CLAIM
from claimweave.operators.keyed import items
from claimweave.operators.text import sentences

CLAIM_ARRAY = T.ArrayType(CLAIM)

# Numbers as a model may write them inside a string.
NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
# JSON values that count as "nothing given"; as strings, all but the empty one are labels.
EMPTY_VALUES = ("0", "0.0", "false", "[]", "{}")


def _claim(**fields) -> Column:
    parts = []
    for field in CLAIM:
        value = fields[field.name]
        value = value if isinstance(value, Column) else F.lit(value)
        parts.append(value.cast(field.dataType).alias(field.name))
    return F.struct(*parts)


def direction(
    sentence: Column,
    null_words: Iterable[str] = vocab.NULL_WORDS,
    mixed_words: Iterable[str] = vocab.MIXED_WORDS,
    negative_words: Iterable[str] = vocab.NEGATIVE_WORDS,
) -> Column:
    """Result of a lower-cased claim sentence; the first matching word list decides."""
    return (
        F.when(contains_any(sentence, null_words), "null")
        .when(contains_any(sentence, mixed_words), "mixed")
        .when(contains_any(sentence, negative_words), "negative")
        .otherwise("positive")
    )


def rule_claims(
    text: str | Column,
    triggers: Iterable[str] = vocab.CLAIM_TRIGGERS,
    null_words: Iterable[str] = vocab.NULL_WORDS,
    mixed_words: Iterable[str] = vocab.MIXED_WORDS,
    negative_words: Iterable[str] = vocab.NEGATIVE_WORDS,
) -> Column:
    """One claim per sentence with a trigger word; a single placeholder claim when there is none."""
    lowered = F.transform(sentences(text), F.lower)
    hits = F.filter(lowered, lambda s: contains_any(s, triggers))
    claims = F.transform(
        hits, lambda s: _claim(**vocab.RULE_CLAIM, result=direction(s, null_words, mixed_words, negative_words))
    )
    none = F.array(_claim(**vocab.NO_CLAIM))
    return let(claims, lambda found: F.when(F.size(found) > 0, found).otherwise(none))


def reply_claims(reply: str | Column) -> Column:
    """Claims of a model reply, or NULL when any part of it cannot be read.

    A reply is a JSON array of objects. An absent field takes its default; an explicit null stays
    null for the text fields, means the default for result and study type, and makes a confidence
    unreadable.
    """
    reply = F.col(reply) if isinstance(reply, str) else reply
    trimmed = F.btrim(reply, F.lit(" \t\n\r"))
    is_array = F.startswith(trimmed, F.lit("[")) & F.endswith(trimmed, F.lit("]"))
    elements = F.try_variant_get(F.when(is_array, F.try_parse_json(trimmed)), "$", "array<variant>")

    def claims_if_readable(parsed: Column) -> Column:
        whole = F.forall(parsed, lambda p: F.coalesce(p["ok"], F.lit(False)))
        return F.when(whole, F.transform(parsed, lambda p: p["claim"]))

    return let(F.transform(elements, _reply_object), claims_if_readable)


def _reply_object(element: Column) -> Column:
    """(ok, claim) of one array element.

    The element is taken apart once, and each field is looked up, typed and written out once.
    """
    names = tuple(vocab.REPLY_DEFAULTS)

    def look(given: Column) -> Column:
        # No kind: the field is absent. An explicit null has one.
        return F.struct(
            F.schema_of_variant(given).alias("kind"), F.try_variant_get(given, "$", "string").alias("written")
        )

    def claim_of(seen: Column) -> Column:
        def field(name):
            return seen[names.index(name)]

        def is_text(name):
            return field(name)["kind"] == "STRING"

        def text(name):
            return F.when(field(name)["kind"].isNull(), vocab.REPLY_DEFAULTS[name]).otherwise(field(name)["written"])

        def is_empty(name):
            written = field(name)["written"]
            return F.coalesce(F.when(is_text(name), written == "").otherwise(written.isin(*EMPTY_VALUES)), F.lit(True))

        def label(name):
            return F.when(is_empty(name), vocab.REPLY_DEFAULTS[name]).otherwise(F.lower(field(name)["written"]))

        number, kind = field("confidence")["written"], field("confidence")["kind"]
        bare_number = F.rlike(kind, F.lit("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)"))
        readable = bare_number | (is_text("confidence") & F.rlike(number, F.lit(NUMBER)))
        as_number = F.when(number == "true", 1.0).when(number == "false", 0.0).otherwise(number.try_cast("double"))
        labels_ok = (is_empty("result") | is_text("result")) & (is_empty("study_type") | is_text("study_type"))
        claim = _claim(
            population=text("population"),
            intervention=text("intervention"),
            outcome=text("outcome"),
            result=label("result"),
            study_type=label("study_type"),
            confidence=F.when(kind.isNull(), vocab.REPLY_DEFAULTS["confidence"]).otherwise(as_number),
        )
        return F.struct((labels_ok & (kind.isNull() | readable)).alias("ok"), claim.alias("claim"))

    def from_fields(fields: Column) -> Column:
        # What is no object has no fields at all and is not ok.
        seen = F.transform(F.array(*map(F.lit, names)), lambda name: look(F.try_element_at(fields, name)))
        return F.when(fields.isNotNull(), let(seen, claim_of))

    return let(F.try_variant_get(element, "$", "map<string,variant>"), from_fields)


def extracted_claims(text: str | Column, reply: str | Column | None = None, **rules) -> Column:
    """Claims of the model reply if it can be read, else claims of the word rules."""
    by_rules = rule_claims(text, **rules)
    return by_rules if reply is None else F.coalesce(reply_claims(reply), by_rules)


def with_replies(
    docs: DataFrame,
    text_col: str,
    model: Callable[[list[str]], list[str]],
    batch_rows: int = 64,
    reply_col: str = "reply",
) -> DataFrame:
    """Add the reply of ``model`` to every document, in Arrow batches.

    ``model`` gets up to ``batch_rows`` whole texts and returns one reply each. A batch that fails
    is tried again text by text; a text that fails alone gets a NULL reply, which falls back to
    the word rules.
    """

    def ask(texts: list[str]) -> list[str | None]:
        try:
            replies = list(model(texts))
            if len(replies) != len(texts):
                raise ValueError("model must return one reply per text")
            return replies
        except Exception:
            if len(texts) == 1:
                return [None]
            return [ask([one])[0] for one in texts]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [t if t is not None else "" for t in frame[text_col]]
            replies: list[str | None] = []
            for start in range(0, len(texts), batch_rows):
                replies += ask(texts[start : start + batch_rows])
            yield frame.assign(**{reply_col: pd.Series(replies, index=frame.index, dtype=object)})

    schema = T.StructType([*docs.schema.fields, T.StructField(reply_col, T.StringType())])
    return docs.mapInPandas(run, schema)


def claim_rows(docs: DataFrame, id_col: str, claims_col: str = "claims") -> DataFrame:
    """One row per extracted claim, numbered inside its document."""
    exploded = items(docs, [id_col], claims_col, "claim_index", "_claim")
    return exploded.select(id_col, "claim_index", "_claim.*")
