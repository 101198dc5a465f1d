"""Secret scans over an incremental blob ledger.

Every version of every text is addressed by the SHA-256 of its bytes. A ledger keeps, per blob, which rule versions have
been run over it and what they found. A scan runs only rules that a blob has not met, once per blob however many paths
hold it, adds the findings to the ledger, and joins the ledger back to all paths. A changed rule gets a new version;
earlier findings stay, for audits, but only those of the rules asked for are returned.

Only hashes and paths are grouped; a text is shuffled once if its blob has something to scan, and Spark's runtime filter
keeps the others out of the shuffle where few are unseen. A blob held by a third of all paths is one row of that join.

Defined cases: a null text is the empty blob; paths may hold nulls and may repeat (every row is returned, with the findings
of its own text); an empty table gives an empty result; further columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import same, whole_text
from claimweave.session import staged


@dataclass(frozen=True)
class Rule:
    """A pattern and the least length of one of its groups. ``hint`` matches whenever the pattern can, and is cheaper."""

    kind: str
    version: int
    pattern: str
    least: int
    hint: str
    group: int = 0

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"

    @cached_property
    def compiled(self) -> re.Pattern:
        # ASCII rules: no other letter counts as the upper or lower case of a keyword's letter.
        return re.compile(self.pattern, re.ASCII)

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.compiled.finditer(text) if len(m[self.group]) >= self.least]


# Keywords and shapes of secrets.
KEYWORDS = "password|passwd|secret|token|api_?key"
BASE_RULES = (
    Rule(
        "assign",
        1,
        rf"((?i:{KEYWORDS}))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        12,
        rf"(?i:{KEYWORDS})[\"']?\x20*[:=]",
        group=2,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 18, "AKIA[A-Z0-9]{14}"),
    Rule("hex", 1, r"[0-9a-f]{16,}", 16, "[0-9a-f]{16}"),
)
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 27, "PRIVATE KEY-----"),
    Rule("login", 1, r"[a-z][a-z0-9+.-]*://[^\s:@/]+:[^\s:@/]{8,}@", 15, "://[^\\s@/]+:[^\\s@/]{8,}@"),
)
RULES = BASE_RULES + MORE_RULES

FOUND = "array<struct<kind:string,version:int,start:bigint,end:bigint>>"
LEDGER = f"blob binary, rules array<string>, found {FOUND}"


def find(rules: Sequence[Rule]):
    """Arrow batches of (blob, todo, text) to the ledger's rows. Whole batches are searched for a rule's hint first."""
    by_id = {r.id: r for r in rules}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, todo = batch["text"], batch["todo"].to_pylist()
            found: list[list] = [[] for _ in todo]
            for rule in rules:
                hit = pc.match_substring_regex(texts, rule.hint)
                for i in pc.indices_nonzero(hit).to_pylist():
                    if rule.id in todo[i]:
                        found[i] += [
                            {"kind": rule.kind, "version": rule.version, "start": a, "end": b}
                            for a, b in rule.spans(texts[i].as_py())
                        ]
            assert all(x in by_id for ids in todo for x in ids)
            kind = pa.list_(
                pa.struct([("kind", pa.string()), ("version", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
            )
            yield pa.RecordBatch.from_arrays(
                [batch["blob"], batch["todo"], pa.array(found, kind)], ["blob", "rules", "found"]
            )

    return scan


def open_ledger(spark, path: str) -> DataFrame:
    """The ledger at ``path``, made if it is not there."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def address(text: str) -> Column:
    return F.unhex(F.sha2(whole_text(text), 256))


def update_ledger(versions: DataFrame, paths: DataFrame, ledger: str, key: Sequence[str], text: str, rules) -> None:
    """Scan what the ledger lacks. ``paths`` has the key's columns as k0, k1, ... and the blob of every row."""
    spark = versions.sparkSession
    ids = F.array(*[F.lit(r.id) for r in rules])
    seen = open_ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
    at = [f"k{i}" for i in range(len(key))]
    unseen = (
        paths.groupBy("blob")
        .agg(F.min(F.struct(*at)).alias("at"))
        .join(seen, "blob", "left")
        .select("blob", "at", F.array_except(ids, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
        .where(F.size("todo") > 0)
    )
    texts = versions.select(
        *[F.col(k).alias(a) for k, a in zip(key, at)], address(text).alias("of"), whole_text(text).alias("text")
    )
    # One path per blob: its text is the only one of the blob that is moved and scanned.
    chosen = texts.join(
        unseen, (texts["of"] == unseen["blob"]) & same([texts[a] for a in at], [unseen["at"][a] for a in at])
    )
    scanned = chosen.select("blob", "todo", "text").mapInArrow(find(rules), LEDGER)
    # A path that repeats has been scanned as often; the ledger gets one row.
    once = scanned.groupBy("blob").agg(F.first("rules").alias("rules"), F.first("found").alias("found"))
    once.write.mode("append").parquet(ledger)


def scan_versions(
    versions: DataFrame, ledger: str, key: Sequence[str] = ("doc_id",), text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per row of ``versions``: the key, ``blob`` and ``spans``, an array of (start, order, end, kind) in order.

    Starts and ends count code points, ends are exclusive; ``order`` is the rule's place in ``rules``.
    """
    spark = versions.sparkSession
    at = [f"k{i}" for i in range(len(key))]
    paths = staged(
        versions.select(*[F.col(k).alias(a) for k, a in zip(key, at)], address(text).alias("blob")), "paths"
    )
    update_ledger(versions, paths, ledger, key, text, rules)
    kinds = F.array(*[F.lit(r.id) for r in rules])
    order = F.array_position(kinds, F.concat_ws("@", "x.kind", F.col("x.version").cast("string"))) - 1
    held = (
        open_ledger(spark, ledger)
        .select("blob", F.explode("found").alias("x"))
        .select("blob", F.struct("x.start", order.cast("int").alias("order"), "x.end", "x.kind").alias("span"))
        .where("span.order >= 0")
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list("span")).alias("spans"))
    )
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    # Staged, so that the join meets plain shuffles and the paths of a hot blob can be split.
    held = staged(held, "held")
    return paths.join(held, "blob", "left").select(
        *[F.col(a).alias(k) for k, a in zip(key, at)], "blob", F.coalesce("spans", none).alias("spans")
    )


def cut(text: str, starts: Iterable[int], ends: Iterable[int], mark: str) -> str:
    """``text`` with ``mark`` for each span or run of overlapping spans, given in order of their starts; linear in both."""
    pieces, done = [], 0
    for start, end in zip(starts, ends):
        if end > done:
            if start >= done:
                pieces += [text[done:start], mark]
            done = end
    return "".join([*pieces, text[done:]])


def _cutter(mark: str):
    @F.pandas_udf("string")
    def cutter(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        rows = zip(texts, starts, ends)
        return pd.Series([None if t is None else cut(t, a, b, mark) for t, a, b in rows], index=texts.index, dtype=object)

    return cutter


def redact(docs: DataFrame, ledger: str, text: str = "text", rules: Sequence[Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping spans are replaced as one.

    Texts are matched to findings by their blob, so columns and rows stay as they are but for the text.
    """
    columns = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in columns], address(f"`{text}`").alias("of"))
    # Any path would do as key: the blob itself is one.
    scanned = scan_versions(
        inner.select("of", F.col(f"in_{text}").alias("body")), ledger, ("of",), "body", rules
    )
    found = scanned.where(F.size("spans") > 0).groupBy("blob").agg(F.first("spans").alias("spans"))
    body = F.col(f"in_{text}")
    joined = inner.join(found, inner["of"] == found["blob"], "left")
    # Only texts with findings go to Python.
    given = F.when(F.col("spans").isNotNull(), body)
    cleaned = F.coalesce(_cutter(mark)(given, F.col("spans.start"), F.col("spans.end")), body)
    return joined.select(*[(cleaned if c == text else F.col(f"`in_{c}`")).alias(c) for c in columns])
