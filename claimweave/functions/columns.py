"""Column expressions. Everything here stays inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions import vocab


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# What makes a trimmed text need its inner white space collapsed.
UNEVEN_SPACE = ("  ", "\t", "\n", "\x0b", "\f", "\r")


def norm_text(value: str | Column) -> Column:
    """Lower case, one space between words, no outer spaces; nothing left means NULL.

    The regular expression runs only on texts that have something to collapse.
    """
    trimmed = F.trim(_col(value))
    even = F.when(contains_any(trimmed, UNEVEN_SPACE), F.regexp_replace(trimmed, r"\s+", " ")).otherwise(trimmed)
    return F.nullif(F.lower(F.trim(even)), F.lit(""))


def mapped(value: str | Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    """Look a value up in a small literal map; what is not in it (NULL too) gets ``default``."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), _col(value))
    return found if default is None else F.coalesce(found, default)


def result_label(normalized: Column) -> Column:
    """Legal label for a normalized result, NULL when there is none."""
    return mapped(normalized, {x: x for x in vocab.RESULT_LABELS} | vocab.RESULT_SYNONYMS)


def study_type_label(normalized: Column) -> Column:
    return mapped(normalized, vocab.STUDY_TYPES, F.lit(vocab.OTHER_STUDY_TYPE))


def is_percent(confidence: Column) -> Column:
    return (confidence > 1) & (confidence <= 100)


def unit_confidence(confidence: Column) -> Column:
    """[0, 1] is kept, (1, 100] is read as a percentage, the rest is NULL."""
    return F.when(confidence.between(0, 1), confidence).when(is_percent(confidence), confidence / 100)


def cluster_number(claim_key: str | Column) -> Column:
    return F.regexp_extract(_col(claim_key), r"^cluster-(\d+):", 1).try_cast("int")


def row_hash(columns, null_token: str = "\u0000") -> Column:
    """SHA-256 over the columns as strings. The session time zone must be UTC."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(null_token)) for c in columns]
    return F.sha2(F.concat_ws("||", *parts), 256)


def claim_pair(intervention="intervention", outcome="outcome") -> Column:
    return F.concat(_col(intervention), F.lit(" -> "), _col(outcome))


def strip(value: str | Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.btrim(_col(value), F.lit(vocab.WHITESPACE))


def claim_key(intervention="intervention", outcome="outcome") -> Column:
    return claim_pair(F.lower(strip(intervention)), F.lower(strip(outcome)))


def cluster_key(cluster: str | Column, intervention="intervention", outcome="outcome") -> Column:
    prefix = F.concat(F.lit("cluster-"), _col(cluster).cast("string"), F.lit(": "))
    return F.concat(prefix, claim_key(intervention, outcome))


def bucket_number(confidence: str | Column) -> Column:
    """0..9; a confidence of exactly 1 falls into the last bucket."""
    return F.least(F.floor(_col(confidence) * 10), F.lit(9)).cast("int")


def bucket_edge(confidence: str | Column) -> Column:
    return bucket_number(confidence) / F.lit(10.0)


def bucket_label(edge: str | Column) -> Column:
    low = F.round(_col(edge) * 100).cast("int")
    return F.concat(low.cast("string"), F.lit("-"), (low + 10).cast("string"), F.lit("%"))


def run_id(at: Column) -> Column:
    """Text order of run ids is their order in time."""
    return F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")


def reject_reason() -> Column:
    """First failed check of a cleaned claim, NULL when it passes."""
    failed = (
        F.col("paper_id").isNull() | F.col("canonical_paper_id").isNull(),
        F.col("result").isNull(),
        F.col("confidence").isNull(),
        F.col("intervention").isNull() | F.col("outcome").isNull(),
    )
    return F.coalesce(*[F.when(test, F.lit(name)) for name, test in zip(vocab.REJECT_REASONS, failed)])


def scaled(value: Column, factor: int) -> Column:
    """Whole number nearest to ``value * factor``. Sums of it are exact in any order."""
    return F.rint(value * factor).cast("bigint")


WEIGHT = "decimal(18,9)"


def exact_weight(value: Column) -> Column:
    """A weight as a decimal with nine places; one that needs more places stops the job instead of being cut.

    Sums of decimals are exact and do not depend on the order of partitions.
    """
    weight = value.cast("double")
    return F.when(weight.isNull() | (weight.cast(WEIGHT).cast("double") == weight), weight.cast(WEIGHT)).otherwise(
        F.raise_error(F.concat(F.lit("weight with more than nine places: "), weight.cast("string"))).cast(WEIGHT)
    )


def stable_mean(value: str | Column, digits: int) -> Column:
    """Rounded mean that does not depend on the order in which partitions are added up.

    Values count in millionths, so two runs on different cluster sizes agree to the last digit.
    """
    value = _col(value)
    return F.round(F.try_divide(F.sum(scaled(value, 1_000_000)), F.count(value) * 1_000_000.0), digits)


def ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    """Quotient as double, NULL for a zero denominator."""
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    return value if digits is None else F.round(value, digits)


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def contains_any(text: Column, words) -> Column:
    return any_of(F.contains(text, F.lit(w)) for w in words)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
