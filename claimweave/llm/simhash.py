"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint is cut into so few segments that two linked fingerprints must agree in one of them but for at most one bit.
Every segment is indexed whole and with each of its bits taken out; equal index entries bring pairs together, which are then
verified. With S segments and at most 2S - 2 differing bits, the last segment needs its whole entry only: if it differed by one
bit and every other one by two or more, the pair would differ by 2S - 1. A variant without bit i only pairs fingerprints that
differ in that bit; those that agree there meet under the whole segment.

Equal texts are one entry, so copies cost nothing here. An entry shared by more than ``LARGE`` fingerprints is not compared
pair by pair: its members are indexed once more with the bits that may still differ taken out, where every group is linked by
construction and holds four fingerprints at most. (496 such variants against comparing with some 500 others: about the same.)

Defined cases of the operators: a null text is empty; null keys sort before others; repeated rows are all returned by
``link_fingerprints`` and reduced to one by the other two; an empty table gives an empty result. ``link_fingerprints`` reads no
further columns, the others keep them all under any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import same, whole_text
from claimweave.llm.components import components
from claimweave.session import staged

SEED = 42
HALF = 32
LARGE = 512
BLOCK = 100_000
LONG_TEXT = 1 << 24


def shingle_hashes(text: str, size: int) -> Iterator[np.ndarray]:
    """XXH64 of all word shingles in blocks; a text of fewer words is one shingle, one of none has none."""
    data = text.encode().lower()
    words = iter(data.split()) if len(data) < LONG_TEXT else (m[0] for m in re.finditer(rb"[^\x20\x09-\x0D]+", data))
    digest, held, first = xxhash.xxh64_intdigest, [], True
    while True:
        fresh = list(islice(words, BLOCK))
        if not fresh and not (first and held):
            return
        block = held + fresh
        if len(block) < size:
            if first and len(fresh) < BLOCK:
                yield np.array([digest(b" ".join(block), SEED)], dtype=np.uint64)
            return
        line = b" ".join(block)
        ends = np.cumsum([len(w) + 1 for w in block]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(block) - size + 1].tolist(), ends[size - 1 :].tolist())
        yield np.array([digest(line[a:b], SEED) for a, b in spans], dtype=np.uint64)
        held, first = block[len(block) - size + 1 :] if size > 1 else [], False


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def majority(counts: np.ndarray, total: int) -> int:
    """The bits set in over half, as an unsigned number."""
    return int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little")


def fingerprint(text: str, size: int = 3) -> int:
    counts, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, size):
        counts, total = counts + bit_counts(hashes), total + len(hashes)
    return majority(counts, total)


def _signed(numbers: list[int]) -> pa.Array:
    return pa.array(np.array(numbers, dtype=np.uint64).view(np.int64))


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, size) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["k"], _signed(prints)], ["k", "print"])

    return run


def _without(value: Column, bits: list[int]) -> Column:
    return value.bitwiseAND(F.lit(~sum(1 << b for b in bits)))


def _entries(halves: tuple[Column, Column]) -> Column:
    """(slot, value, side): both halves whole, and the first one without each of its bits; ``side`` is that bit."""
    first, second = halves
    whole = [
        F.struct(F.lit(slot).alias("slot"), half.alias("value"), F.lit(None).cast("int").alias("side"))
        for slot, half in enumerate((first, second))
    ]
    cut = [
        F.struct(
            F.lit(2 + i).alias("slot"),
            _without(first, [i]).alias("value"),
            F.shiftright(first, i).bitwiseAND(F.lit(1)).cast("int").alias("side"),
        )
        for i in range(HALF)
    ]
    return F.array(*whole, *cut)


def _finer(halves: tuple[Column, Column]) -> Column:
    """What members of a large entry must share to be linked: the rest without the bits that may differ."""
    first, second = halves
    pairs = [~((1 << i) | (1 << j)) for i in range(HALF) for j in range(i)]

    def masked(half: Column, masks: list[int]) -> Column:
        return F.transform(
            F.array(*map(F.lit, masks)).cast("array<bigint>"),
            lambda m, i: F.struct(i.alias("gap"), half.bitwiseAND(m).alias("rest")),
        )

    def twice(half: Column) -> Column:
        return masked(half, pairs)

    once = masked(second, [~(1 << i) for i in range(HALF)])
    return F.when(F.col("slot") == 0, twice(second)).when(F.col("slot") == 1, twice(first)).otherwise(once)


def linked_pairs(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct 64-bit fingerprints that span all links at two or fewer differing bits.

    Every pair returned is a link. From entries of up to ``LARGE`` members all links are returned, from larger ones enough
    of them to connect what is linked.
    """
    low = F.col("print").bitwiseAND(F.lit((1 << HALF) - 1))
    high = F.shiftrightunsigned("print", HALF)
    halves = (low, high)
    entries = prints.select("print", F.inline(_entries(halves)))
    counts = entries.groupBy("slot", "value").agg(
        F.count("*").alias("members"), F.count_if(F.col("side") == 0).alias("clear"), F.count_if(F.col("side") == 1).alias("set")
    )
    shared = staged(
        counts.where("slot < 2 AND members > 1 OR slot >= 2 AND clear > 0 AND `set` > 0").select("slot", "value", "members"),
        "shared-entries",
    )
    met = staged(entries.join(shared, ["slot", "value"]), "entries")
    small, large = met.where(F.col("members") <= LARGE), met.where(F.col("members") > LARGE)
    a = small.select("slot", "value", F.col("print").alias("a"), F.col("side").alias("side_a"))
    b = small.select("slot", "value", F.col("print").alias("b"), F.col("side").alias("side_b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    apart = F.when(F.col("side_a").isNull(), F.col("a") < F.col("b")).otherwise(
        (F.col("side_a") == 0) & (F.col("side_b") == 1)
    )
    compared = a.join(
        b, (a["slot"] == b["slot"]) & (a["value"] == b["value"]) & near & apart
    ).select("a", "b")
    groups = (
        large.select("slot", "value", "print", F.inline(_finer(halves)))
        .groupBy("slot", "value", "gap", "rest")
        .agg(F.collect_set("print").alias("group"))
        .where(F.size("group") > 1)
    )
    hung = groups.select(F.array_min("group").alias("a"), F.explode("group").alias("b")).where("a <> b")
    return compared.unionByName(hung).distinct()


def link_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """Per row: the key, ``print`` (the fingerprint as a signed long) and ``component`` (the smallest key reachable)."""
    rows = docs.select(F.col(key).alias("k"), whole_text(text).alias("text"))
    kind = rows.schema["k"].dataType.simpleString()
    prints = staged(rows.mapInArrow(_fingerprints(size), f"k {kind}, print bigint"), "prints")
    classes = staged(prints.groupBy("print").agg(F.min("k").alias("lowest")), "classes")
    labels = staged(components(linked_pairs(classes.select("print")), "a", "b"), "labels")
    inside = classes.join(labels, F.col("print") == F.col("node")).select("print", "component", "lowest")
    lowest = staged(inside.groupBy("component").agg(F.min("lowest").alias("of_component")), "lowest")
    reached = inside.join(lowest, "component").select("print", "of_component")
    known = staged(
        classes.join(reached, "print", "left").select("print", F.coalesce("of_component", "lowest").alias("component")),
        "reached",
    )
    return prints.join(known, "print").select(F.col("k").alias(key), "print", "component")


def first_of_linked(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """One row of each group of linked fingerprints: the one with the smallest key, and of equal keys one text.

    Rows that agree in key and text are one. All columns stay, under any names.
    """
    own = "near_key"
    while own in docs.columns:
        own += "_"
    keyed = docs.withColumn(own, F.struct(F.col(key).alias("id"), F.xxhash64(whole_text(text)).alias("h")))
    linked = link_fingerprints(keyed, own, text, size)
    firsts = linked.where(F.col(own).eqNullSafe(F.col("component"))).groupBy(F.col(own).alias("first")).agg(F.count("*").alias("n"))
    firsts = staged(firsts.select(F.col("first.id").alias("first_id"), F.col("first.h").alias("first_h"), "n"), "firsts")
    ids, hashes = F.col(f"{own}.id"), F.col(f"{own}.h")

    def rows(chosen: DataFrame) -> DataFrame:
        here = chosen.select(*[F.col(c).alias(f"{own}_{c}") for c in ("first_id", "first_h")])
        match = ids.eqNullSafe(F.col(f"{own}_first_id")) & (hashes == F.col(f"{own}_first_h"))
        return keyed.join(here, match, "left_semi")

    kept = rows(firsts.where("n = 1"))
    repeated = firsts.where("n > 1")
    if not repeated.isEmpty():
        kept = kept.unionByName(rows(repeated).dropDuplicates([own]))
    return kept.drop(own)


# --- one document of each group ---------------------------------------------------------------

def mixed(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Further hashes from given ones."""
    x = hashes + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_print(text: str) -> tuple[int, int]:
    """Two times 63 bits over the distinct word pairs of a text; no stage needs them any more."""
    blocks = list(shingle_hashes(text, 2))
    hashes = np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, np.uint64)
    return tuple(majority(bit_counts(mixed(hashes, salt)), len(hashes)) & (2**63 - 1) for salt in (1, 2))


def distinct_shingles(text: str, size: int) -> np.ndarray:
    blocks = list(shingle_hashes(text, size))
    return np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, np.uint64)


def at_least(share: float, of: int) -> int:
    """The least whole number that is ``share`` of ``of``, never more of it by rounding."""
    return int(np.ceil(share * of - 1e-6))


def prefix(shingles: np.ndarray, common: np.ndarray, levels: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles in one order for all texts (rare before common, then by hash) of which a similar text has one."""
    level = np.zeros(len(shingles), np.int8)
    if len(common):
        place = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        level = np.where(common[place] == shingles, levels[place], 0)
    length = len(shingles) - at_least(similarity, len(shingles)) + 1 if len(shingles) else 0
    return shingles[np.lexsort((shingles, level))[:length]]


def _common_shingles(rows: DataFrame, size: int, sample: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that recur in a sample of the texts, sorted, with the order of magnitude of their counts.

    They only order the shingles; any order finds the same pairs, so the sample changes time and never results.
    """
    drawn = F.pmod(F.col("t"), F.lit(2**31)) < min(1.0, sample / max(rows.count(), 1)) * 2.0**31
    texts = rows.where(drawn).dropDuplicates(["t"]).select(F.col("t").alias("id"), "text")
    counts = (
        texts.mapInArrow(_shingle_sets(size), "id bigint, shingles array<bigint>")
        .select(F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("n"))
        .where("n > 3")
        .orderBy(F.desc("n"), "shingle")
        .limit(most)
        .toPandas()
    )
    shingles = counts["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], np.log2(counts["n"].to_numpy(np.float64)).astype(np.int8)[order]


def _prefixes(size: int, similarity: float, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, levels = shared.value
        for batch in batches:
            same_words, n, short, first = [], [], [], []
            for text in batch["text"].to_pylist():
                same_words.append(xxhash.xxh3_128_digest(b" ".join(text.encode().lower().split())))
                found = distinct_shingles(text, size)
                n.append(len(found))
                # Where the other text is as long or longer, fewer do.
                short.append(len(found) - at_least(2 * similarity / (1 + similarity), len(found)) + 1)
                first.append(prefix(found, common, levels, similarity).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["k"],
                    batch["t"],
                    pa.array(same_words, pa.binary()),
                    pa.array(n, pa.int32()),
                    pa.array(short, pa.int32()),
                    pa.array(first, pa.list_(pa.int64())),
                ],
                ["k", "t", "words", "n", "short", "entries"],
            )

    return run


def _met(left: DataFrame, right: DataFrame, by: list[str], similarity: float) -> DataFrame:
    """Pairs (a, b) that share an entry, b not shorter than a, and can be similar by their sizes and the entry's places."""
    a = left.where("place < short").select(*by, F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("place").alias("at_a"))
    b = right.select(*by, F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("at_b"))
    sizes = (F.col("n_a") < F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))
    # True at the first shingle that the two share: none of those before is common.
    rest = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    enough = rest + 1e-6 >= similarity / (1 + similarity) * (F.col("n_a") + F.col("n_b"))
    return a.join(b, by).where(sizes & enough).select("a", "b")


def members_of(prefixes: DataFrame) -> DataFrame:
    """Rows (id, n, short, place, entry, members) of the entries that two or more texts share."""
    return _shared(prefixes.select("id", "n", "short", F.posexplode("entries").alias("place", "entry")))


def _shared(entries: DataFrame) -> DataFrame:
    counts = (
        entries.groupBy("entry")
        .agg(F.count("*").alias("members"), F.count_if(F.col("place") < F.col("short")).alias("first"))
        .where("members > 1 AND first > 0")
    )
    return entries.join(counts.select("entry", "members"), "entry")


def thinned(rows: DataFrame, classes: DataFrame, members: DataFrame, size: int, similarity: float, large: int):
    """``members`` without large groups of copies, and the ids of the texts that go.

    A text that comes first in all of its entries stays, as nothing before it can be similar to it. It is compared with all
    that share an entry with it, which is linear in those; what is similar goes, and neither needs a further comparison.
    Rounds end when entries of more than ``large`` members no longer shrink by half: those hold texts that are not copies of
    each other, and are left for ``candidates``.
    """
    gone = None
    while crowded := members.where(F.col("members") > large).count():
        ids = members.groupBy("id").agg(F.max("members").alias("most"), F.count("*").alias("entries")).where(F.col("most") > large)
        ids = staged(ids, "crowd")
        # Those in crowded entries come before all others, so only they can lead.
        rank = F.struct((-F.col("most")).alias("order"), F.col("id"))
        heads = members.join(ids, "id").groupBy("entry").agg(F.min(rank)["id"].alias("id"))
        leaders = staged(
            heads.groupBy("id").agg(F.count("*").alias("led")).join(ids, "id").where("led = entries").select("id"), "leaders"
        )
        leading = members.join(leaders, "id")
        met = _met(leading, members, ["entry"], similarity).unionByName(_met(members, leading, ["entry"], similarity))
        found = similar(rows, classes, staged(met.distinct(), "leading"), size, similarity)
        # Leaders share no entries with each other: exactly one of each pair leads.
        out = found.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(leaders, "id", "left_anti")
        out = staged(out, "gone")
        gone = out if gone is None else gone.unionByName(out)
        settled = out.unionByName(leaders)
        members = staged(_shared(members.drop("members").join(settled, "id", "left_anti")), "members")
        if 2 * members.where(F.col("members") > large).count() > crowded:
            break
    return members, gone


def candidates(members: DataFrame, similarity: float, block: int) -> DataFrame:
    """All pairs of texts (id) that can have ``similarity``: both hold one shingle among their first ones.

    Entries of more than ``block`` members are compared block by block, each pair of blocks in a row group of its own.
    """
    few, many = members.where(F.col("members") <= block), members.where(F.col("members") > block)
    blocks = F.ceil(F.col("members") / block).cast("int")
    many = many.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    left = many.withColumn("row", F.col("own")).withColumn("col", other)
    right = many.withColumn("col", F.col("own")).withColumn("row", other)
    met = _met(few, few, ["entry"], similarity)
    return met.unionByName(_met(left, right, ["entry", "row", "col"], similarity)).distinct()


def _shingle_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [distinct_shingles(text, size).view(np.int64) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    return run


def drop_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    similarity: float = 0.8,
    large: int = 64,
    block: int = 512,
    sample: int = 50_000,
    most: int = 200_000,
) -> DataFrame:
    """``docs`` without exact and near copies: one document of each group stays.

    Of two documents that stay, the distinct shingles of ``size`` words have a Jaccard similarity below ``similarity``; each
    one that goes has that or more with one that stays. Large groups of copies go first (see ``thinned``). Of the
    rest, every similar pair is a candidate (see ``candidates``) and every candidate is verified. Classes of equal word sequences are visited by their number of candidates, then copies: one
    without an earlier candidate stays, and its verified partners go; a round settles all such classes at once.

    ``block``, ``sample`` and ``most`` change time only, ``large`` also which one of a group stays.
    """
    inner = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns])
    rows = inner.select(
        F.col(f"in_{key}").alias("k"), F.xxhash64(f"in_{text}").alias("t"), whole_text(f"in_{text}").alias("text")
    )
    kind = rows.schema["k"].dataType.simpleString()
    common = rows.sparkSession.sparkContext.broadcast(_common_shingles(rows, size, sample, most))
    columns = f"k {kind}, t bigint, words binary, n int, short int, entries array<bigint>"
    prints = staged(rows.mapInArrow(_prefixes(size, similarity, common), columns), "prefixes")
    classes = staged(
        prints.groupBy("words")
        .agg(
            F.min(F.struct("k", "t")).alias("at"),
            F.count("*").alias("copies"),
            F.first(F.struct("n", "short", "entries")).alias("of"),
        )
        .select(F.monotonically_increasing_id().alias("id"), "at", "copies", "of.*"),
        "classes",
    )
    members, copies = thinned(rows, classes, staged(members_of(classes), "members"), size, similarity, large)
    pairs = staged(candidates(members, similarity, block), "candidates")
    dropped = _settle(rows, classes, pairs, size, similarity)
    dropped = dropped if copies is None else dropped.unionByName(copies)
    kept = classes.join(dropped, "id", "left_anti").select("at.k", "at.t")
    # Rows with equal key and text are copies, too.
    repeated = prints.groupBy("k", "t").agg(F.count("*").alias("rows"))
    kept = staged(
        kept.alias("x")
        .join(repeated.alias("y"), same([F.col("x.k"), F.col("x.t")], [F.col("y.k"), F.col("y.t")]))
        .select(F.col("x.k").alias("kept_k"), F.col("x.t").alias("kept_t"), "rows"),
        "kept",
    )
    found = inner.join(
        kept,
        F.col(f"in_{key}").eqNullSafe(F.col("kept_k")) & (F.xxhash64(f"in_{text}") == F.col("kept_t")),
    )
    single = found.where("rows = 1").select(*inner.columns)
    several = (
        found.where("rows > 1")
        .groupBy("kept_k", "kept_t")
        .agg(F.first(F.struct(*inner.columns)).alias("row"))
        .select("row.*")
    )
    whole = single.unionByName(several)
    return whole.select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns])


def similar(rows: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts have ``similarity``."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    at = staged(nodes.join(classes, "id").select("id", "at"), "nodes")
    texts = rows.join(at, same([rows["k"], rows["t"]], [at["at.k"], at["at.t"]])).select("id", "text")
    shingles = texts.mapInArrow(_shingle_sets(size), "id bigint, shingles array<bigint>")
    # A key that repeats with its text gives one set.
    sets = staged(shingles.dropDuplicates(["id"]), "shingle-sets")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    alike = common >= similarity * (F.size("of_a") + F.size("of_b") - common)
    return staged(pairs.join(left, "a").join(right, "b").where(alike).select("a", "b"), "similar")


def _settle(rows: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, similarity: float) -> DataFrame:
    """The ids of the classes that go.

    All candidates are verified at once. Then rounds of small joins settle who stays.
    """
    spark = rows.sparkSession
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    ranked = staged(
        nodes.join(classes, "id").select("id", F.struct(-F.col("degree"), -F.col("copies"), F.col("id")).alias("rank")),
        "ranked",
    )
    of = {x: ranked.select(F.col("id").alias(x), F.col("rank").alias(f"rank_{x}")) for x in "ab"}
    earlier = F.col("rank_a") < F.col("rank_b")
    edges = staged(
        similar(rows, classes, pairs, size, similarity)
        .join(of["a"], "a")
        .join(of["b"], "b")
        .select(
            F.when(earlier, F.col("a")).otherwise(F.col("b")).alias("a"),
            F.when(earlier, F.col("b")).otherwise(F.col("a")).alias("b"),
        ),
        "verified",
    )
    gone = [spark.createDataFrame([], "id bigint")]
    while edges.limit(1).count():
        first = staged(
            edges.select("a").distinct().join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_anti"), "first"
        )
        out = staged(edges.join(first, "a").select(F.col("b").alias("id")).distinct(), "gone")
        gone.append(out)
        rest = edges.join(first, "a", "left_anti")
        rest = rest.join(out.select(F.col("id").alias("a")), "a", "left_anti")
        edges = staged(rest.join(out.select(F.col("id").alias("b")), "b", "left_anti"), "ordered")
    return reduce(DataFrame.unionByName, gone)
