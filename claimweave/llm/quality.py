"""Quality rules with thresholds that follow each language and source.

Fixed cut-offs reject whole languages and styles. Here every document gets a few whole-number measures; a mergeable
quantile sketch (a count per measure value, so two sketches merge by adding counts) is kept per language and source, and
a document fails where a measure lies far outside the middle half of its own group. Everything is DataFrame expressions.

Defined cases: a null or empty text has no words and fails; null languages and sources form groups of their own; repeated
rows are judged alike and all returned; an empty table gives an empty result; other columns pass through, and a column of
the input that is named like one of the results is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimweave.llm.base import SPACE, once, whole_text
from claimweave.session import staged

# White space and the characters that count as symbols.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Measure:
    """A whole number per document, and how far outside its group's quartiles it may lie."""

    name: str
    value: str
    slack: int
    low: bool = False
    high: bool = True


# Twentieths of a character per word; thousandths of the characters, lines and words.
MEASURES = (
    Measure("word_length", "20 * word_chars div nullif(n_words, 0)", 30, low=True),
    Measure("symbol_share", "1000 * n_symbols div nullif(word_chars, 0)", 50),
    Measure("dup_line_share", "1000 * n_dup_lines div nullif(n_lines, 0)", 400),
    Measure("repeat_share", "1000 * n_repeat_words div nullif(n_words, 0)", 350),
)


def _window_hashes(words: Column, window: int) -> Column:
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (window - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, window)]),
    )


def _covered(hashes: Column, window: int) -> Column:
    """Words inside windows that the text holds twice or more.

    Hashes are sorted together with their positions, so equal windows are neighbours; the positions of those are sorted
    again and the words that they cover are counted, overlaps once.
    """

    def repeated(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda x, i: (F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"]),
        )

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    places = F.sort_array(F.transform(once(F.sort_array(placed), repeated), lambda x: x["at"]))
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, at: F.struct(
            (at + window).alias("end"), (acc["n"] + at + window - F.greatest(at, acc["end"])).alias("n")
        ),
        lambda acc: acc["n"],
    )


def measure(docs: DataFrame, text: str = "text", window: int = 3) -> DataFrame:
    """``docs`` with the counts of ``COUNTS`` as long columns."""
    body = whole_text(text)
    none = F.lit(0).cast("bigint")
    words = F.filter(F.split(body, SPACE), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")

    def repeats(hashes: Column) -> Column:
        # Most texts repeat no window, which a hash set tells; only the others are sorted.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), none).otherwise(_covered(hashes, window))

    of_words = once(
        words,
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.aggregate(w, none, lambda acc, x: acc + F.char_length(x)).alias("chars"),
            once(_window_hashes(w, window), repeats).alias("repeats"),
        ),
    )
    of_lines = once(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
    counted = docs.withColumn("_counted", F.struct(of_words.alias("words"), of_lines.alias("lines")))
    long = {
        "n_words": F.col("_counted.words.n"),
        "word_chars": F.col("_counted.words.chars"),
        "n_symbols": F.regexp_count(body, F.lit(f"[{SYMBOLS}]")),
        "n_lines": F.col("_counted.lines.n"),
        "n_dup_lines": F.col("_counted.lines.n") - F.col("_counted.lines.distinct"),
        "n_repeat_words": F.col("_counted.words.repeats"),
    }
    return counted.withColumns({k: v.cast("bigint") for k, v in long.items()}).drop("_counted")


def sketches(measured: DataFrame, keys: tuple[str, ...], measures=MEASURES) -> DataFrame:
    """One row per key, measure and value with the count of documents: mergeable by adding the counts."""
    values = F.array(
        *[F.struct(F.lit(m.name).alias("measure"), F.expr(m.value).alias("value")) for m in measures]
    )
    return (
        measured.where("n_words > 0")
        .select(*keys, F.inline(values))
        .where("value IS NOT NULL")
        .groupBy(*keys, "measure", "value")
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The sketches of coarser groups, from those of finer ones."""
    return sketch.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Per key and measure: the documents behind it and the lower and upper quartile, as values that occur."""
    group = Window.partitionBy(*keys, "measure")
    upto = F.sum("n").over(group.orderBy("value"))
    ranked = sketch.withColumn("_upto", upto).withColumn("_all", F.sum("n").over(group))

    def at(quarters: int) -> Column:
        return F.min(F.when(4 * F.col("_upto") >= quarters * F.col("_all"), F.col("value")))

    return ranked.groupBy(*keys, "measure").agg(
        F.max("_all").alias("docs"), at(1).alias("lower"), at(3).alias("upper")
    )


def fences(
    measured: DataFrame, lang: str = "lang", source: str = "source", least_docs: int = 200, reach: int = 4, measures=MEASURES
) -> DataFrame:
    """One row per language and source: ``<measure>_low`` and ``<measure>_high``, null where a side is open.

    A fence lies ``reach`` interquartile ranges and the measure's slack beyond the quartile. Groups of fewer than
    ``least_docs`` documents take the quartiles of their language, small languages those of all documents; these
    come from merged sketches, not from the documents again.
    """
    fine = staged(
        sketches(measured.withColumns({"_lang": F.col(lang), "_source": F.col(source)}), ("_lang", "_source"), measures),
        "sketches",
    )
    by_lang = merged(fine, ("_lang",))
    overall = merged(by_lang, ())

    def named(df: DataFrame, tag: str) -> DataFrame:
        return df.withColumnsRenamed({x: f"{x}{tag}" for x in ("docs", "lower", "upper")})

    own = quantiles(fine, ("_lang", "_source"))
    middle = named(quantiles(by_lang, ("_lang",)), "_1").withColumnsRenamed({"_lang": "_lang_1", "measure": "m_1"})
    top = named(quantiles(overall, ()), "_2").withColumnRenamed("measure", "m_2")
    joined = own.join(
        middle, F.col("_lang").eqNullSafe(F.col("_lang_1")) & (F.col("measure") == F.col("m_1"))
    ).join(top, F.col("measure") == F.col("m_2"))

    def pick(name: str) -> Column:
        return (
            F.when(F.col("docs") >= least_docs, F.col(name))
            .when(F.col("docs_1") >= least_docs, F.col(f"{name}_1"))
            .otherwise(F.col(f"{name}_2"))
        )

    chosen = joined.select("_lang", "_source", "measure", pick("lower").alias("lower"), pick("upper").alias("upper"))
    spread = reach * (F.col("upper") - F.col("lower"))
    columns = []
    for m in measures:
        mine = F.col("measure") == m.name
        if m.low:
            columns.append(F.max(F.when(mine, F.col("lower") - spread - m.slack)).alias(f"{m.name}_low"))
        if m.high:
            columns.append(F.max(F.when(mine, F.col("upper") + spread + m.slack)).alias(f"{m.name}_high"))
    return chosen.groupBy("_lang", "_source").agg(*columns)


def judge(
    measured: DataFrame,
    lang: str = "lang",
    source: str = "source",
    least_words: int = 50,
    most_repeated: int = 50,
    least_docs: int = 200,
    reach: int = 4,
    measures=MEASURES,
) -> DataFrame:
    """``measured`` with ``base_failed``, ``failed`` (names of the measures outside their fences) and ``kept``.

    The fences are one row per language and source; their join with the documents is an ordinary equi-join that Spark
    broadcasts if it is small and whose hot groups adaptive execution splits otherwise.
    """
    measured = measured.drop("base_failed", "failed", "kept")
    limits = fences(measured, lang, source, least_docs, reach, measures)
    joined = measured.join(
        limits,
        measured[lang].eqNullSafe(limits["_lang"]) & measured[source].eqNullSafe(limits["_source"]),
        "left",
    )
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    outside = []
    for m in measures:
        value, tests = F.expr(m.value), []
        if m.low:
            tests.append(value < F.col(f"{m.name}_low"))
        if m.high:
            tests.append(value > F.col(f"{m.name}_high"))
        outside.append(F.when((F.col("n_words") > 0) & reduce(lambda a, b: a | b, tests), F.lit(m.name)))
    judged = joined.withColumn("base_failed", base).withColumn("failed", F.array_compact(F.array(*outside)))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    return judged.drop(*limits.columns)


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", **rules) -> DataFrame:
    """The documents that pass, with the columns of ``docs``. Texts are measured once and staged with the counts."""
    counted = staged(measure(docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns]), f"in_{text}"), "measured")
    kept = judge(counted, f"in_{lang}", f"in_{source}", **rules).where("kept")
    return kept.select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns])
