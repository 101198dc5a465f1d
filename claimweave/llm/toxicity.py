"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, texts without a label the unlabelled sample, and nothing is ever learned from a
negative label. The risk of a linear model on word presence is estimated as ``prior * R(positive, +) + max(0, R(unlabelled,
-) - prior * R(positive, -))``; where the last difference turns negative, its gradient is reversed, so that the model cannot
explain the positives hidden among the unlabelled as negatives. The classifier is numpy; counting words, choosing the
vocabulary, drawing the samples and scoring are Spark jobs.

Features of a text are its words (punctuation around them cut off) and all runs of ``PART`` characters in them, so that a stem
tells under any beginning or ending. A word of more than ``WORD_BYTES`` bytes, such as a sentence in a script without spaces or
words glued together, is no feature as a whole; its runs are. Features are counted over all texts. The vocabulary is the
features whose shares of texts differ between the two sides by ``least_z`` standard errors or more, the ``vocabulary`` clearest
of them, however rare they are. ``sample`` bounds the texts that the classifier is fitted on, per side; they are the ones with
the smallest hashes of their text. So what reaches the driver is bounded by these parameters. Scoring reads every whole text.

Where no text lacks a label, all texts are the unlabelled sample.

Defined cases: a null text is empty; an empty text has the score of no known word; a null label is no label; without a
positive example every score is the prior; an empty table gives an empty result; repeated rows
are scored alike and all returned; further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import lower_words, whole_text
from claimweave.session import staged

WORD_BYTES = 64
PART = 5
# Features counted in a task before they are handed on.
COUNTED = 500_000
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def plain_words(text: str) -> set[bytes]:
    """Distinct words of a text in lower case, without the punctuation around them."""
    return {w.strip(PUNCTUATION) for w in set(lower_words(text))}


def runs(letters: str) -> Iterator[bytes]:
    return (letters[i : i + PART].encode() for i in range(len(letters) - PART + 1))


@lru_cache(maxsize=1 << 16)
def short_parts(word: bytes) -> tuple[bytes, ...]:
    return (word, *runs(word.decode()))


def parts(word: bytes) -> Iterable[bytes]:
    """All runs of ``PART`` characters in a word and, if it has ``WORD_BYTES`` bytes or fewer, the word itself."""
    return short_parts(word) if len(word) <= WORD_BYTES else set(runs(word.decode()))


def features(text: str) -> set[bytes]:
    return {x for w in plain_words(text) for x in parts(w)}


@dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]
    bias: float

    def score(self, text: str) -> float:
        # Summed in the order of the features, so that the same text has the same score everywhere.
        known = sorted({x for w in plain_words(text) for x in parts(w) if x in self.weights})
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(self.weights[w] for w in known), -500, 500))))


def fit(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    width: int,
    prior: float,
    epochs: int = 30,
    batch: int = 512,
    rate: float = 0.05,
    decay: float = 1e-4,
    seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the non-negative risk's minimiser; texts are arrays of word numbers below ``width``."""
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(width), float(np.log(prior / (1 - prior)))
    moment, square = np.zeros(width + 1), np.zeros(width + 1)

    def dense(texts: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(texts), width + 1))
        for row, words in zip(x, texts):
            row[words] = 1
        x[:, width] = 1
        return x

    step = 0
    for _ in range(epochs):
        places = rng.permutation(len(unlabelled))
        for start in range(0, len(places), batch):
            u = dense([unlabelled[i] for i in places[start : start + batch]])
            p = dense([positive[i] for i in rng.integers(0, len(positive), batch)])
            theta = np.append(weights, bias)
            su, sp = (1 / (1 + np.exp(-np.clip(x @ theta, -30, 30))) for x in (u, p))
            # Logistic losses: -log s for the positive class, -log(1 - s) for the negative one.
            hidden = -np.log1p(-su + 1e-12).mean() + prior * np.log1p(-sp + 1e-12).mean()
            negative = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
            gradient = prior * (p.T @ (sp - 1)) / len(p) + negative if hidden >= 0 else -negative
            gradient[:width] += decay * weights
            step += 1
            moment = 0.9 * moment + 0.1 * gradient
            square = 0.999 * square + 0.001 * gradient**2
            theta -= rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            weights, bias = theta[:width], float(theta[width])
    return weights, bias


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per feature and side; the null feature is in every text."""
    sides = {"positive": Counter(), "unlabelled": Counter()}

    def counted() -> pa.RecordBatch:
        names = list(sides["positive"].keys() | sides["unlabelled"].keys())
        columns = [pa.array(names, pa.binary()), *(pa.array([c[x] for x in names], pa.int64()) for c in sides.values())]
        return pa.RecordBatch.from_arrays(columns, ["feature", "p", "u"])

    for batch in batches:
        for text, *on in zip(*(batch[c].to_pylist() for c in ("text", *sides))):
            found = features(text)
            for side, counts in zip(on, sides.values()):
                if side:
                    counts.update(found)
                    counts[None] += 1
            if sum(map(len, sides.values())) > COUNTED:
                yield counted()
                for counts in sides.values():
                    counts.clear()
    yield counted()


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = 20_000,
    vocabulary: int = 4_096,
    least_z: float = 6.0,
    prior: float | None = None,
) -> Model:
    """Fit on ``docs``; ``prior`` is the share of toxic texts, by default that among the labelled ones."""
    tagged = labels.groupBy(F.col(key).alias("k")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    texts = docs.select(F.col(key).alias("k"), F.xxhash64(whole_text(text)).alias("h"), whole_text(text).alias("text"))
    # Copies of one text are one example; only keys and hashes are shuffled.
    marked = staged(
        texts.select("k", "h")
        .join(tagged, "k", "left")
        .groupBy("h")
        .agg(F.min("k").alias("k"), F.max("toxic").alias("toxic")),
        "marked",
    )
    sizes = {
        r["toxic"]: r["n"]
        for r in marked.groupBy(F.coalesce("toxic", F.lit(-1)).alias("toxic")).agg(F.count("*").alias("n")).collect()
    }
    positives, negatives, others = sizes.get(1, 0), sizes.get(0, 0), sizes.get(-1, 0)
    if prior is None:
        prior = min(max(positives / max(positives + negatives, 1), 1e-3), 0.5)
    if not positives:
        return Model({}, float(np.log(prior / (1 - prior))))
    sides = marked.select(
        "k", "h", (F.coalesce("toxic", F.lit(0)) == 1).alias("positive"), (F.col("toxic").isNull() if others else F.lit(True)).alias("unlabelled")
    )
    others = others or positives + negatives

    counts = staged(
        texts.join(sides.where("positive OR unlabelled"), ["k", "h"])
        .select("text", "positive", "unlabelled")
        .mapInArrow(_count_features, "feature binary, p bigint, u bigint")
        .groupBy("feature")
        .agg(F.sum("p").alias("p"), F.sum("u").alias("u")),
        "features",
    )
    totals = counts.where("feature IS NULL").first()
    if totals is None or not totals["p"] or not totals["u"]:
        return Model({}, float(np.log(prior / (1 - prior))))
    p, u = totals["p"], totals["u"]
    pooled = (F.col("p") + F.col("u") + 1) / (p + u + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / p + 1 / u))
    contrast = F.abs(F.col("p") / p - F.col("u") / u) / error
    chosen = [
        bytes(r["feature"])
        for r in counts.where(F.col("feature").isNotNull() & (contrast >= least_z))
        .orderBy(contrast.desc(), "feature")
        .limit(vocabulary)
        .select("feature")
        .collect()
    ]
    place = {w: i for i, w in enumerate(chosen)}

    def drawn(side: str, n: int):
        small = F.pmod("h", F.lit(2**31)) < min(1.0, sample / n) * 2.0**31
        return sides.where(F.col(side) & small).select("k", "h", F.lit(side == "positive").alias("positive"))

    # About two times ``sample`` rows of numbers: the texts stay where they are.
    sampled = texts.join(F.broadcast(drawn("positive", positives).unionByName(drawn("unlabelled", others))), ["k", "h"])
    numbered = sampled.select("h", "positive", "text").mapInArrow(
        _numbers(place), "h bigint, positive boolean, words array<int>"
    )
    fitted: dict[bool, list[np.ndarray]] = {True: [], False: []}
    for row in numbered.dropDuplicates(["h", "positive"]).toLocalIterator():
        fitted[row["positive"]].append(np.asarray(row["words"], dtype=np.int64))
    if not fitted[True] or not fitted[False]:
        return Model({}, float(np.log(prior / (1 - prior))))
    for texts_of in fitted.values():
        texts_of.sort(key=lambda a: a.tobytes())
    weights, bias = fit(fitted[True], fitted[False], len(chosen), prior)
    return Model({w: float(weights[i]) for w, i in place.items()}, bias)


def _numbers(place: dict[bytes, int]):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [sorted(place[x] for x in features(text) if x in place) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["h"], batch["positive"], pa.array(numbers, pa.list_(pa.int32()))], ["h", "positive", "words"]
            )

    return number


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and ``score`` of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fitted = Model(*shared.value)
            scores = [fitted.score(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["k"], pa.array(scores, pa.float64())], ["k", "score"])

    rows = docs.select(F.col(key).alias("k"), whole_text(text).alias("text"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, score double").withColumnRenamed("k", key)
