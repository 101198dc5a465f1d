import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from claimweave.functions import vocab
from claimweave.operators import extraction, text


def expected_chunks(body, size, overlap):
    step = size - overlap
    found = [body[i : i + size].strip() for i in range(0, len(body), step)]
    return [c for c in found if c]


@pytest.mark.parametrize("length", [0, 1, 1300, 1301, 1400, 1500, 2801])
def test_chunk_lengths(spark, length):
    body = ("word é. " * 400)[:length]
    df = spark.createDataFrame([(body,)], "t string")
    assert df.select(text.chunks("t")).first()[0] == expected_chunks(body, 1500, 200)


def test_chunks_strip_unicode_space_and_drop_empty_ones(spark):
    body = "  a " + " " * 30 + "b\x1c　"
    df = spark.createDataFrame([(7, body), (8, " \n  ")], "paper_id long, full_text string")
    rows = text.chunk_documents(df, size=10, overlap=2).orderBy("chunk_index").collect()
    assert [r.content for r in rows] == expected_chunks(body, 10, 2)
    assert [r.chunk_id for r in rows] == [f"7:{i}" for i in range(len(rows))]


def test_sentences(spark):
    body = "One. Two! Three?\nFour.Five  . . six\x1c"
    row = spark.createDataFrame([(body,)], "t string").select(text.sentences("t")).first()[0]
    assert row == re.split(r"(?<=[.!?])\s+", body)


def results(spark, body, **options):
    df = spark.createDataFrame([(body,)], "t string")
    return [c.result for c in df.select(extraction.rule_claims("t", **options)).first()[0]]


def test_rule_directions(spark):
    assert results(spark, "No significant decrease here.") == ["null"]
    assert results(spark, "Mixed reduction. It did IMPROVE. An increase to lower values. Lower only.") == [
        "mixed",
        "positive",
        "negative",
    ]
    df = spark.createDataFrame([("Only lower values.",), ("",)], "t string")
    for row in df.select(extraction.rule_claims("t").alias("c")).collect():
        assert [c.asDict() for c in row.c] == [vocab.NO_CLAIM]


def test_whole_texts_are_read(spark):
    body = "Nothing. " * 12 + "Late increase. " + "x" * 13000 + ". Very late decrease."
    assert results(spark, body) == ["positive", "negative"]


def test_chunks_are_windows_of_the_whole_text(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n\U0001f642") for _ in range(n)) for n in (0, 1, 5, 9, 10, 11, 60, 61)] + ["   "]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string")
    for size, overlap in ((10, 3), (7, 0), (9, 7), (1, 0)):
        rows = {r.i: r.c for r in df.select("i", text.chunks("t", size, overlap).alias("c")).collect()}
        for i, x in enumerate(texts):
            assert rows[i] == expected_chunks(x, size, overlap)


def test_long_texts_are_cut_in_linear_time(spark):
    df = spark.createDataFrame([("ab cd " * 700_000,)], "t string")
    start = time.perf_counter()
    assert df.select(F.size(text.chunks("t"))).first()[0] == 3231
    assert time.perf_counter() - start < 15


def fields(**given):
    base = {
        "population": "unknown",
        "intervention": "unknown",
        "outcome": "unknown",
        "result": "null",
        "study_type": "observational",
        "confidence": 0.5,
    }
    return {**base, **given}


UNREADABLE = None
FULL = {"population": "p", "intervention": "i", "outcome": "o", "result": "Mixed", "study_type": "RCT", "confidence": 0.7}
REPLIES = [
    ("[]", []),
    ("  \n [ ]  ", []),
    ("[{}]", [fields()]),
    (json.dumps([FULL]), [{**FULL, "result": "mixed", "study_type": "rct"}]),
    ('[{"result": null, "study_type": ""}, {"confidence": " 0.25 "}]', [fields(), fields(confidence=0.25)]),
    ('[{"population": null, "confidence": 1}]', [fields(population=None, confidence=1.0)]),
    ('[{"confidence": "1e-2"}, {"confidence": true}]', [fields(confidence=0.01), fields(confidence=1.0)]),
    ('[{"result": 0, "study_type": false}]', [fields()]),
    ('[{"confidence": null}]', UNREADABLE),
    ('[{"confidence": "high"}]', UNREADABLE),
    ('[{"confidence": "0.5d"}]', UNREADABLE),
    ('[{"confidence": [1]}]', UNREADABLE),
    ('[{"result": 5}]', UNREADABLE),
    ('[{"result": "null"}, 3]', UNREADABLE),
    ("[1]", UNREADABLE),
    ("[null]", UNREADABLE),
    ('{"population": "p"}', UNREADABLE),
    ("not json", UNREADABLE),
    ('[{"population": "p"}', UNREADABLE),
    ('[{"population": "p"}] trailing', UNREADABLE),
    ("", UNREADABLE),
]


def test_replies(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(REPLIES)], "i int, r string")
    rows = {x.i: x.c for x in df.select("i", extraction.reply_claims("r").alias("c")).collect()}
    for i, (reply, expected) in enumerate(REPLIES):
        found = None if rows[i] is None else [c.asDict() for c in rows[i]]
        assert found == expected, reply


def test_unreadable_replies_fall_back_to_the_rules(spark):
    df = spark.createDataFrame([("A decrease.", "oops"), ("A decrease.", "[]"), ("x", None)], "t string, r string")
    rows = [r[0] for r in df.select(extraction.extracted_claims("t", "r")).collect()]
    assert [[c.result for c in r] for r in rows] == [["negative"], [], ["null"]]


def test_model_failures_stay_with_their_text(spark):
    def model(texts):
        if any("bad" in x for x in texts):
            raise RuntimeError("no answer")
        return [json.dumps([{"intervention": x}]) for x in texts]

    df = spark.createDataFrame([(i, "bad" if i == 3 else f"t{i}") for i in range(10)], "i int, t string").coalesce(1)
    rows = {r.i: r.reply for r in extraction.with_replies(df, "t", model, batch_rows=4).collect()}
    assert rows[3] is None and json.loads(rows[2]) == [{"intervention": "t2"}] and len(rows) == 10


def test_chunking_needs_no_shuffle(spark):
    df = spark.range(3).select("id", F.lit("a. b").alias("t"))
    plan = text.chunk_documents(df, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_strings_that_look_empty_are_labels(spark):
    reply = json.dumps([{"result": "0", "study_type": "False"}, {"result": 0, "study_type": False}, {"result": [], "study_type": ""}])
    df = spark.createDataFrame([(reply,)], "r string")
    claims = df.select(extraction.reply_claims("r").alias("c")).first().c
    assert [(c.result, c.study_type) for c in claims] == [("0", "false"), ("null", "observational"), ("null", "observational")]
