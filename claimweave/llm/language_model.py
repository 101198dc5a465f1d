"""Language-model scores: a log-bilinear neural model trained with noise-contrastive estimation.

The model predicts the class of the next token from the classes of the two before it. Frequent words and the end mark are
classes of their own; every other word belongs to a class by its last two bytes, and a class shares its probability among its
words by their counts, plus half a count for all words never seen. A context is the sum of one vector per position; the score
of a class is the product of context and class vector plus a bias.

Training sees the exact counts of all class triples of the training texts. These are summed by Spark; the table is bounded by
the number of classes (``frequent``, ``endings``, ``coarse``), not by the corpus, so numpy can draw its batches from it on the
driver. One batched matrix product over all contexts then gives the normalised log-probabilities, and scoring is a lookup.

Word counts cover all training tokens. Their head, at most ``head`` words of at most ``WORD_BYTES`` bytes, is broadcast; the
words of a text outside it are joined to the full table by word, one row per text and distinct word.

Defined cases: a null text is empty and has the end mark as its only token; repeated rows are all returned; with no training
text, counts are zero and every token has the probability of an unknown word; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import lower_words, whole_text
from claimweave.session import staged

WORD_BYTES = 64
# The end mark as a token: no word holds a blank.
END = b" "


@dataclass(frozen=True)
class Classes:
    """Class numbers: 0 is the end mark, then the frequent words, then the endings."""

    frequent: tuple[bytes, ...]
    endings: int
    coarse: int

    @property
    def size(self) -> int:
        return 1 + len(self.frequent) + self.endings

    def numbers(self) -> dict[bytes, int]:
        return {END: 0} | {w: i + 1 for i, w in enumerate(self.frequent)}

    def ending(self, word: bytes) -> int:
        return 1 + len(self.frequent) + zlib.crc32(word[-2:]) % self.endings

    def blurred(self, numbers: np.ndarray) -> np.ndarray:
        """Classes as the farther context position sees them: the first ones, and groups of the others."""
        half = self.coarse // 2
        return np.where(numbers < half, numbers, half + numbers % (self.coarse - half))


@dataclass(frozen=True)
class Vectors:
    """Context vectors of the nearer and farther position, class vectors and biases."""

    near: np.ndarray
    far: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def log10_table(self) -> np.ndarray:
        """log10 of the normalised probabilities, by farther context, nearer context and class."""
        table = np.empty((len(self.far), len(self.near), len(self.out)), dtype=np.float32)
        for i, far in enumerate(self.far):
            scores = (self.near + far) @ self.out.T + self.bias
            top = scores.max(axis=1, keepdims=True)
            table[i] = (scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))) / np.log(10)
        return table


def gathered(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the values per row number."""
    order = np.argsort(rows, kind="stable")
    found, starts = np.unique(rows[order], return_index=True)
    out = np.zeros((size, *values.shape[1:]))
    out[found] = np.add.reduceat(values[order], starts)
    return out


def train(
    far: np.ndarray,
    near: np.ndarray,
    target: np.ndarray,
    counts: np.ndarray,
    n_far: int,
    n_classes: int,
    width: int = 24,
    steps: int = 2_000,
    batch: int = 2_048,
    noise: int = 128,
    rate: float = 0.02,
    seed: int = 11,
) -> Vectors:
    """Noise-contrastive estimation on weighted triples; the noise are classes drawn by their share."""
    rng = np.random.default_rng(seed)
    share = np.bincount(target, counts, n_classes) + 0.5
    share /= share.sum()
    shapes = {"near": (n_classes, width), "far": (n_far, width), "out": (n_classes, width), "bias": (n_classes,)}
    values = {k: rng.normal(0, 0.1, s) for k, s in shapes.items()}
    values["bias"] = np.log(share)
    if not len(counts):
        return Vectors(**values)
    moments = {k: (np.zeros(s), np.zeros(s)) for k, s in shapes.items()}
    upto, noise_upto = np.cumsum(counts / counts.sum()), np.cumsum(share)
    log_noise = np.log(noise * share)
    last = len(counts) - 1
    for step in range(1, steps + 1):
        drawn = np.minimum(np.searchsorted(upto, rng.random(batch)), last)
        w, c1, c2 = target[drawn], near[drawn], far[drawn]
        n = np.minimum(np.searchsorted(noise_upto, rng.random(noise)), n_classes - 1)
        context = values["near"][c1] + values["far"][c2]
        true = (context * values["out"][w]).sum(1) + values["bias"][w] - log_noise[w]
        false = context @ values["out"][n].T + values["bias"][n] - log_noise[n]
        miss = (1 / (1 + np.exp(-np.clip(true, -30, 30))) - 1) / batch
        hit = 1 / (1 + np.exp(-np.clip(false, -30, 30))) / batch
        pull = miss[:, None] * values["out"][w] + hit @ values["out"][n]
        grads = {
            "near": gathered(c1, pull, n_classes),
            "far": gathered(c2, pull, n_far),
            "out": gathered(w, miss[:, None] * context, n_classes) + gathered(n, hit.T @ context, n_classes),
            "bias": gathered(w, miss, n_classes) + gathered(n, hit.sum(0), n_classes),
        }
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            m, s = moments[k]
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            values[k] -= pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-10)
    return Vectors(**values)


def tokens_of(text: str) -> list[bytes]:
    return [*lower_words(text), END]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for text in batch["text"].to_pylist():
            counts.update(tokens_of(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )


def word_counts(texts: DataFrame) -> DataFrame:
    counts = texts.select("text").mapInArrow(_count_words, "word binary, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).withColumn("step", F.floor(F.log2("n") * 8).cast("int"))


def commonest(counts: DataFrame, room: int) -> dict[bytes, int]:
    """At most ``room`` words and their counts, by whole steps of the count (an eighth of a doubling)."""
    short = counts.where(F.octet_length("word") <= WORD_BYTES)
    least = None
    for row in short.groupBy("step").count().orderBy(F.desc("step")).collect():
        if row["count"] > room:
            break
        least, room = row["step"], room - row["count"]
    if least is None:
        return {}
    table = short.where(F.col("step") >= least).select("word", "n").toArrow()
    return dict(zip(table["word"].to_pylist(), table["n"].to_pylist()))


class Reader:
    """Tokens of a text as numbers of the head (-1 outside) and as classes."""

    def __init__(self, head: dict[bytes, int], classes: Classes):
        self.place = {w: i for i, w in enumerate(head)}
        self.counts = np.fromiter(head.values(), np.float64, len(head))
        own = classes.numbers()
        self.classes = classes
        self.of_head = np.fromiter(
            (own[w] if w in own else classes.ending(w) for w in head), np.int64, len(head)
        )

    def read(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        get = self.place.get
        places = np.array([get(w, -1) for w in tokens], dtype=np.int64)
        kinds = self.of_head[places] if len(self.of_head) else np.zeros(len(tokens), np.int64)
        for i in np.flatnonzero(places < 0):
            kinds[i] = 0 if tokens[i] == END else self.classes.ending(tokens[i])
        return places, kinds

    def contexts(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The farther (blurred) and nearer class before each token; a text begins after two end marks."""
        near = np.concatenate(([0], kinds[:-1]))
        return self.classes.blurred(np.concatenate(([0], near[:-1]))), near


def _count_triples(shared, classes: Classes):
    size = classes.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total = Reader(shared.value, classes), None
        held: list[np.ndarray] = []

        def folded() -> tuple[np.ndarray, np.ndarray]:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            if total is None:
                return keys, n
            both, at = np.unique(np.concatenate((total[0], keys)), return_inverse=True)
            return both, np.bincount(at, np.concatenate((total[1], n))).astype(np.int64)

        waiting = 0
        for batch in batches:
            for text in batch["text"].to_pylist():
                _, kinds = reader.read(tokens_of(text))
                far, near = reader.contexts(kinds)
                held.append((far * size + near) * size + kinds)
                waiting += len(kinds)
                if waiting >= 2_000_000:
                    total, held, waiting = folded(), [], 0
        if held:
            total = folded()
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(total[0]), pa.array(total[1].astype(np.int64))], ["triple", "n"])

    return run


def _score(shared, classes: Classes, vectors, mass):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, log_mass = Reader(shared.value, classes), np.log10(mass)
        table = Vectors(*vectors).log10_table()
        log_counts = np.log10(reader.counts + 0.5) if len(reader.counts) else np.zeros(1)
        alone = 1 + len(classes.frequent)
        # The unknown word's half count, until the join below adds the difference.
        unknown = np.log10(0.5)
        for batch in batches:
            rows = []
            for text in batch["text"].to_pylist():
                tokens = tokens_of(text)
                places, kinds = reader.read(tokens)
                far, near = reader.contexts(kinds)
                inside, shared_class = places >= 0, kinds >= alone
                logs = np.where(inside, log_counts[places], unknown)
                score = (
                    table[far, near, kinds].sum(dtype=np.float64)
                    + logs[shared_class].sum()
                    - log_mass[kinds[shared_class]].sum()
                )
                rest = Counter([tokens[i] for i in np.flatnonzero(~inside)])
                known = int((inside & (reader.counts[places] > 0)).sum()) if len(reader.counts) else 0
                rows.append(
                    (len(tokens), known, float(logs.sum()), float(score), [{"word": w, "n": n} for w, n in rest.items()])
                )
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch["k"], *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["k", "n_tokens", "known", "logs", "score", "rest"],
            )

    return run


def score_texts(
    docs: DataFrame,
    learned: Column,
    key: str = "doc_id",
    text: str = "text",
    frequent: int = 255,
    endings: int = 128,
    coarse: int = 64,
    head: int = 200_000,
) -> DataFrame:
    """Per row: the key, n_tokens, n_known, train_tokens, base_score (unigram) and score (the model's), both log10.

    ``learned`` selects the rows that are trained on. The base gives a token ``(c + 0.5) / (N + 0.5 * (V + 1))``.
    """
    spark = docs.sparkSession
    body = whole_text(text)
    training = docs.where(learned).select(body.alias("text"))
    counts = staged(word_counts(training), "word-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    common = commonest(counts, head)
    ranked = sorted(((n, w) for w, n in common.items() if w != END), key=lambda x: (-x[0], x[1]))
    classes = Classes(tuple(w for _, w in ranked[:frequent]), endings, coarse)
    shared = spark.sparkContext.broadcast(common)

    triples = (
        training.mapInArrow(_count_triples(shared, classes), "triple bigint, n bigint")
        .groupBy("triple")
        .agg(F.sum("n").alias("n"))
    )
    table = triples.toArrow()
    keys, weights = table["triple"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order].astype(np.float64)
    size = classes.size
    vectors = train(keys // (size * size), keys // size % size, keys % size, weights, coarse, size)

    # Counts within each shared class, and half a count for its unseen words.
    own = classes.numbers()
    ending = F.pmod(F.crc32(F.expr("substring(word, -2, 2)")), F.lit(endings)) + (1 + len(classes.frequent))
    sums = counts.where(~F.col("word").isin(*own)).groupBy(ending.cast("int").alias("c")).agg(F.sum(F.col("n") + 0.5).alias("s"))
    mass = np.full(size, 0.5)
    for row in sums.collect():
        mass[row["c"]] += row["s"]

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), body.alias("text"))
    fields = f"k {kind}, n_tokens bigint, known bigint, logs double, score double, rest array<struct<word:binary,n:bigint>>"
    parts = (vectors.near, vectors.far, vectors.out, vectors.bias)
    scored = staged(
        rows.mapInArrow(_score(shared, classes, parts, mass), fields).withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    # Words outside the head that have a count: the difference to what an unknown word was given.
    asked = scored.select("row", F.inline("rest"))
    tail = counts.where(~F.col("word").isin(END)).select("word", F.col("n").alias("c"))
    found = asked.join(tail, "word")
    added = found.groupBy("row").agg(
        F.sum("n").alias("more"), F.sum(F.col("n") * (F.log10(F.col("c") + 0.5) - float(np.log10(0.5)))).alias("gain")
    )
    log_all = float(np.log10(totals["n"] + 0.5 * (totals["v"] + 1)))
    gain = F.coalesce("gain", F.lit(0.0))
    return (
        scored.drop("rest")
        .join(added, "row", "left")
        .select(
            F.col("k").alias(key),
            "n_tokens",
            (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(totals["n"]).cast("bigint").alias("train_tokens"),
            (F.col("logs") + gain - F.col("n_tokens") * log_all).alias("base_score"),
            (F.col("score") + gain).alias("score"),
        )
    )
