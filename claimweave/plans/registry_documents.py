"""Registered queries over text, vectors, snapshots and streams."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions import columns as C
from claimweave.functions import schemas, vocab
from claimweave.functions.columns import let
from claimweave.operators import clusters, extraction, text, vectors
from claimweave.operators.keyed import latest_versions, sequential_ids
from claimweave.plans import ingest, pipeline
from claimweave.plans import tables as t
from claimweave.plans.oracles import CTES
from claimweave.plans.registry import query
from claimweave.session import scratch_dir
from claimweave.sources import bronze, versions
from claimweave.sources.documents import decode_text
from claimweave.sources.studies import parse_studies
from claimweave.streaming import runs as run_stream
from claimweave.streaming import uploads

SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# --- text -----------------------------------------------------------------------------------

CTES["v_chunks"] = f"""
SELECT doc_id, unnest(cs) AS content, CAST(generate_subscripts(cs, 1) - 1 AS INT) AS chunk_index
FROM (SELECT doc_id, list_filter(list_transform(generate_series(0, length(text) - 1, 1300),
        lambda s: trim(substr(text, CAST(s AS INT) + 1, 1500), {SPACE})), lambda c: c <> '') AS cs FROM documents)"""

CTES["v_sentences"] = r"""
SELECT doc_id, unnest(ss) AS sentence, CAST(generate_subscripts(ss, 1) - 1 AS INT) AS sentence_index
FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS ss FROM documents)"""


@query("SELECT doc_id, doc_id || ':' || chunk_index AS chunk_id, chunk_index, 'body' AS section, content FROM v_chunks")
def chunk_documents(spark, sf_dir):
    return text.chunk_documents(t.read(spark, sf_dir, "documents"), "doc_id", "text")


@query("SELECT doc_id, sentence_index, sentence FROM v_sentences")
def sentences(spark, sf_dir):
    return text.sentence_rows(t.read(spark, sf_dir, "documents"), "doc_id", "text")


# The test texts are invented words, so the rules get word lists that occur in them.
RULES = {
    "triggers": ("thon", "eaux", "schst"),
    "null_words": (" of ", " de "),
    "mixed_words": (" and ", " und "),
    "negative_words": (" in ", " la "),
}

CTES["v_rule_claims"] = """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY sentence_index) - 1 AS INT) AS claim_index,
  'adults' AS population, 'intervention from paper' AS intervention, 'primary outcome' AS outcome,
  CASE WHEN contains(s, ' of ') OR contains(s, ' de ') THEN 'null' WHEN contains(s, ' and ') OR contains(s, ' und ') THEN 'mixed'
       WHEN contains(s, ' in ') OR contains(s, ' la ') THEN 'negative' ELSE 'positive' END AS result,
  'observational' AS study_type, 0.35::DOUBLE AS confidence
FROM (SELECT doc_id, sentence_index, lower(sentence) AS s FROM v_sentences)
WHERE contains(s, 'thon') OR contains(s, 'eaux') OR contains(s, 'schst')"""

CTES["v_doc_claims"] = """
SELECT * FROM v_rule_claims UNION ALL
SELECT doc_id, 0, 'unknown', 'unspecified intervention', 'unspecified outcome', 'null', 'observational', 0.2::DOUBLE
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM v_rule_claims)"""


@query("SELECT * FROM v_doc_claims")
def extract_claims(spark, sf_dir):
    docs = t.read(spark, sf_dir, "documents")
    return extraction.claim_rows(docs.withColumn("claims", extraction.rule_claims("text", **RULES)), "doc_id")


CTES["v_replies"] = """
SELECT o_orderkey AS doc_id,
  CASE o_orderstatus WHEN 'F' THEN 'Deaths decrease with dose. Cost did improve! Nothing else.'
    WHEN 'P' THEN 'Mixed effects improve sleep. No significant reduction was seen.' ELSE 'Nothing to report.' END AS body,
  CASE o_orderpriority
    WHEN '1-URGENT' THEN '[{"population":"customer ' || o_custkey || '","intervention":" Drug A ","outcome":"Pain","result":"Positive","study_type":"RCT","confidence":"0.75"}]'
    WHEN '2-HIGH' THEN '[{"intervention":"drug b"},{"outcome":"sleep","result":null,"study_type":"","confidence":0.25}]'
    WHEN '3-MEDIUM' THEN '[{"population":"x","confidence":null}]'
    WHEN '4-NOT SPECIFIED' THEN '{"population":"x"}' ELSE 'sorry, no claims' END AS reply
FROM orders"""


def _replies(spark, sf_dir) -> DataFrame:
    """Model replies of several kinds, built from order rows."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    good = F.concat(
        F.lit('[{"population":"customer '),
        F.col("o_custkey").cast("string"),
        F.lit('","intervention":" Drug A ","outcome":"Pain","result":"Positive","study_type":"RCT","confidence":"0.75"}]'),
    )
    sparse = '[{"intervention":"drug b"},{"outcome":"sleep","result":null,"study_type":"","confidence":0.25}]'
    return t.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.when(status == "F", "Deaths decrease with dose. Cost did improve! Nothing else.")
        .when(status == "P", "Mixed effects improve sleep. No significant reduction was seen.")
        .otherwise("Nothing to report.")
        .alias("body"),
        F.when(priority == "1-URGENT", good)
        .when(priority == "2-HIGH", sparse)
        .when(priority == "3-MEDIUM", '[{"population":"x","confidence":null}]')
        .when(priority == "4-NOT SPECIFIED", '{"population":"x"}')
        .otherwise("sorry, no claims")
        .alias("reply"),
    )


CTES["v_reply_kinds"] = "SELECT *, json_valid(reply) AND left(trim(reply), 1) = '[' AS is_array FROM v_replies"
CTES["v_reply_elements"] = """
SELECT doc_id, unnest(es) AS e, generate_subscripts(es, 1) - 1 AS claim_index
FROM (SELECT doc_id, CAST(CAST(reply AS JSON) AS JSON[]) AS es FROM v_reply_kinds WHERE is_array)"""
CTES["v_reply_bad"] = """
SELECT doc_id FROM v_reply_kinds WHERE NOT is_array
UNION SELECT doc_id FROM v_reply_elements WHERE json_type(e) <> 'OBJECT' OR json_type(e, '$.confidence') = 'NULL'"""
CTES["v_reply_hits"] = r"""
SELECT doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS claim_index
FROM (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i
      FROM (SELECT doc_id, string_split(lower(regexp_replace(body, '([.!?])\s+', '\1' || chr(1), 'g')), chr(1)) AS ss
            FROM v_reply_kinds JOIN v_reply_bad USING (doc_id)))
WHERE contains(s, 'increase') OR contains(s, 'improve') OR contains(s, 'reduction') OR contains(s, 'decrease')
  OR contains(s, 'no significant')"""


@query(
    """
SELECT doc_id, CAST(claim_index AS INT) AS claim_index,
  CASE WHEN list_contains(json_keys(e), 'population') THEN e->>'population' ELSE 'unknown' END AS population,
  CASE WHEN list_contains(json_keys(e), 'intervention') THEN e->>'intervention' ELSE 'unknown' END AS intervention,
  CASE WHEN list_contains(json_keys(e), 'outcome') THEN e->>'outcome' ELSE 'unknown' END AS outcome,
  lower(coalesce(nullif(e->>'result', ''), 'null')) AS result,
  lower(coalesce(nullif(e->>'study_type', ''), 'observational')) AS study_type,
  coalesce(CAST(e->>'confidence' AS DOUBLE), 0.5) AS confidence
FROM v_reply_elements WHERE doc_id NOT IN (SELECT doc_id FROM v_reply_bad)
UNION ALL
SELECT doc_id, CAST(claim_index AS INT), 'adults', 'intervention from paper', 'primary outcome',
  CASE WHEN contains(s, 'no significant') THEN 'null' WHEN contains(s, 'mixed') THEN 'mixed'
       WHEN contains(s, 'decrease') OR contains(s, 'reduction') OR contains(s, 'lower') THEN 'negative' ELSE 'positive' END,
  'observational', 0.35
FROM v_reply_hits
UNION ALL
SELECT doc_id, 0, 'unknown', 'unspecified intervention', 'unspecified outcome', 'null', 'observational', 0.2
FROM v_reply_bad WHERE doc_id NOT IN (SELECT doc_id FROM v_reply_hits)"""
)
def parse_model_output(spark, sf_dir):
    replies = _replies(spark, sf_dir)
    return extraction.claim_rows(replies.withColumn("claims", extraction.extracted_claims("body", "reply")), "doc_id")


def first_word_model(texts: list[str]) -> list[str]:
    """Stands in for a model: fails on questions, else names the first word as intervention."""
    if any("?" in x for x in texts):
        raise ValueError("unreadable")
    return ['[{"intervention":"%s"}]' % (x.split() or [""])[0].replace('"', "").replace("\\", "") for x in texts]


@query(
    r"""
SELECT doc_id, CASE WHEN contains(text, '?') THEN NULL ELSE
  replace(replace(coalesce(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')[1], ''), '"', ''), '\', '') END AS intervention
FROM documents"""
)
def model_replies(spark, sf_dir):
    docs = t.read(spark, sf_dir, "documents").select("doc_id", "text")
    replies = extraction.with_replies(docs, "text", first_word_model)
    claims = extraction.reply_claims("reply")
    return replies.select("doc_id", F.get(claims, F.lit(0))["intervention"].alias("intervention"))


@query("SELECT doc_id, text FROM documents")
def decode_documents(spark, sf_dir):
    """Texts as bytes with an invalid byte in front; decoding drops it."""
    raw = F.concat(F.unhex(F.lit("FF")), F.encode("text", "UTF-8"))
    return t.read(spark, sf_dir, "documents").select("doc_id", decode_text(raw).alias("text"))


def letter_counts(texts: list[str]) -> np.ndarray:
    return np.array([[x.count(c) for c in "abcdefghijklmnopqrstuvwxyz"] for x in texts], dtype=np.float32)


@query(
    "SELECT doc_id || ':' || chunk_index AS chunk_id, array_to_string(["
    + ", ".join(f"length(content) - length(replace(content, '{c}', ''))" for c in "abcdefghijklmnopqrstuvwxyz")
    + "], ',') AS embedding FROM v_chunks"
)
def embed_chunks(spark, sf_dir):
    chunks = text.chunk_documents(t.read(spark, sf_dir, "documents"), "doc_id", "text")
    embedded = vectors.embed(chunks.select("chunk_id", "content"), "content", letter_counts)
    numbers = F.transform("embedding", lambda x: x.cast("int").cast("string"))
    return embedded.select("chunk_id", F.array_join(numbers, ",").alias("embedding"))


def hashed_words_sql() -> str:
    """Slots and counts of the hashed words: a word's bytes times powers of the base, modulo two to the 64th."""
    powers, power = [], 1
    for _ in range(400):
        power = power * vectors.HASH_BASE % 2**64
        powers.append(f"{power}::HUGEINT")
    return f"""
WITH chunk_words AS (
  SELECT doc_id || ':' || chunk_index AS chunk_id, word, count(*) AS n
  FROM (SELECT doc_id, chunk_index, unnest(regexp_extract_all(lower(content), '[0-9a-zA-Z_\\x{{80}}-\\x{{10FFFF}}]+')) AS word FROM v_chunks)
  GROUP BY ALL),
hashed AS (
  SELECT word, ((list_sum(list_transform(range(len(h) // 2), lambda i:
    ('0x' || substr(h, CAST(2 * i + 1 AS INT), 2))::HUGEINT * powers[i + 1])) % 18446744073709551616::HUGEINT)
    // 131072::HUGEINT) % {vocab.EMBEDDING_SIZE} AS slot
  FROM (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM chunk_words)), (SELECT [{", ".join(powers)}] AS powers)),
counted AS (SELECT chunk_id, CAST(slot AS INT) AS slot, sum(n) AS n FROM chunk_words JOIN hashed USING (word) GROUP BY ALL),
shares AS (
  SELECT chunk_id, string_agg(slot || ':' || CAST(round(1000 * n / least_n) AS BIGINT), ',' ORDER BY slot) AS slots
  FROM (SELECT *, min(n) OVER (PARTITION BY chunk_id) AS least_n FROM counted) GROUP BY chunk_id)
SELECT doc_id || ':' || chunk_index AS chunk_id, {vocab.EMBEDDING_SIZE} AS size, coalesce(slots, '') AS slots,
  slots IS NOT NULL AS is_unit
FROM v_chunks LEFT JOIN shares ON chunk_id = doc_id || ':' || chunk_index"""


@query(hashed_words_sql())
def embed_chunks_hashed(spark, sf_dir):
    """Per chunk the slots of its vector in thousandths of the smallest one, and whether its length is one."""
    chunks = text.chunk_documents(t.read(spark, sf_dir, "documents"), "doc_id", "text")
    embedded = vectors.embed(chunks.select("chunk_id", "content"), "content")
    # The few slots in use are all that is looked at, and the least of them is found once a vector.
    used = F.filter(
        F.transform("embedding", lambda x, i: F.struct(i.alias("slot"), x.cast("double").alias("x"))), lambda s: s["x"] > 0
    )

    def listed(slots):
        def share(least):
            return F.transform(
                slots,
                lambda s: F.concat_ws(
                    ":", s["slot"].cast("string"), F.round(1000 * s["x"] / least).cast("bigint").cast("string")
                ),
            )

        return F.array_join(let(F.array_min(F.transform(slots, lambda s: s["x"])), share), ",")

    def digest(slots):
        square = F.aggregate(slots, F.lit(0.0), lambda a, s: a + s["x"] * s["x"])
        return F.struct(listed(slots).alias("slots"), (F.abs(square - 1) < 1e-5).alias("is_unit"))

    found = embedded.select("chunk_id", F.size("embedding").alias("size"), let(used, digest).alias("found"))
    return found.select("chunk_id", "size", "found.slots", "found.is_unit")


# --- vectors --------------------------------------------------------------------------------

CTES["v_centroids"] = """
SELECT label AS centroid_id, list(m ORDER BY i) AS centroid
FROM (SELECT label, i, avg(x) AS m FROM (
        SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
      GROUP BY 1, 2) GROUP BY 1"""

NEAREST = """
SELECT vec_id, CAST(centroid_id AS BIGINT) AS centroid_id FROM (
  SELECT vec_id, c.centroid_id, row_number() OVER (PARTITION BY vec_id ORDER BY
    list_cosine_similarity(CAST(embedding AS DOUBLE[]), c.centroid) DESC, c.centroid_id) AS place
  FROM embeddings, v_centroids c) WHERE place = 1"""


def _centroids(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    table = t.read(spark, sf_dir, "embeddings")
    return table, vectors.mean_centroids(table, "label", "embedding", 64)


@query(NEAREST)
def nearest_centroid(spark, sf_dir):
    return vectors.nearest_centroid(*_centroids(spark, sf_dir)).select("vec_id", "centroid_id")


@query(NEAREST)
def nearest_centroid_in_blocks(spark, sf_dir):
    """The same with many small blocks."""
    found = vectors.nearest_centroid(*_centroids(spark, sf_dir), block_numbers=256, rows_per_group=4096)
    return found.select("vec_id", "centroid_id")


PARTS = 8


def linkage_sql() -> str:
    """Average linkage step by step: the closest two clusters of a document become one while they are close enough.

    A cluster's number is its first member, so the final labels are its rank.
    """
    steps = [
        f"""parts AS (
  SELECT vec_id, i, CASE WHEN vec_id % 3 = 0 AND i % 2 = 1 THEN list_transform(embedding[8 * i - 7:8 * i], lambda x: x * 3)
    ELSE embedding[8 * i + 1:8 * i + 8] END AS v
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, unnest(range({PARTS})) AS i FROM embeddings))""",
        """apart AS (
  SELECT a.vec_id, a.i AS x, b.i AS y, 1 - list_cosine_similarity(a.v, b.v) AS d FROM parts a JOIN parts b USING (vec_id))""",
        "s0 AS (SELECT vec_id, i, i AS c FROM parts)",
    ]
    for n in range(1, PARTS):
        steps.append(f"""s{n} AS MATERIALIZED (
  SELECT s.vec_id, i, if(c = gone, into_c, c) AS c FROM s{n - 1} s LEFT JOIN (
    SELECT vec_id, arg_min(a, d) AS into_c, arg_min(b, d) AS gone FROM (
      SELECT p.vec_id, p.c AS a, q.c AS b, avg(d) AS d FROM s{n - 1} p JOIN s{n - 1} q ON p.vec_id = q.vec_id AND p.c < q.c
      JOIN apart t ON t.vec_id = p.vec_id AND x = p.i AND y = q.i GROUP BY ALL HAVING avg(d) < {vocab.CLUSTER_THRESHOLD})
    GROUP BY vec_id) m ON m.vec_id = s.vec_id)""")
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, string_agg(label, ',' ORDER BY i) AS labels
FROM (SELECT vec_id, i, dense_rank() OVER (PARTITION BY vec_id ORDER BY c) - 1 AS label FROM s{PARTS - 1}) GROUP BY vec_id"""
    )


def _document_parts():
    """Each vector cut into eight parts, which stand for the claim vectors of one document.

    In every third document each second part is the one before it, scaled, so that there is something to merge.
    """

    def part(i):
        own = F.slice("embedding", i * 8 + 1, F.lit(8))
        copied = F.transform(F.slice("embedding", F.greatest(i * 8 - 7, F.lit(1)), F.lit(8)), lambda x: x * 3)
        return F.when((F.col("vec_id") % 3 == 0) & (i % 2 == 1), copied).otherwise(own)

    return F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.transform(part(i), lambda x: x.cast("float")))


@query(linkage_sql())
def cluster_claims(spark, sf_dir):
    """A document's claim vectors in one array."""
    labels = F.transform(vectors.cluster_labels(_document_parts()), lambda x: x.cast("string"))
    return t.read(spark, sf_dir, "embeddings").select("vec_id", F.array_join(labels, ",").alias("labels"))


@query(linkage_sql())
def cluster_claim_rows(spark, sf_dir):
    """The same documents with a row for each claim, merged in rounds of mutual nearest neighbours."""
    table = t.read(spark, sf_dir, "embeddings")
    claims = table.select("vec_id", F.posexplode(_document_parts()).alias("i", "v"))
    labels = clusters.cluster_claims(claims, "vec_id", "i", "v", local=1, tile=4)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("i", "label"))), lambda x: x["label"].cast("string"))
    return labels.groupBy("vec_id").agg(F.array_join(in_order, ",").alias("labels"))


# --- ingestion ------------------------------------------------------------------------------


def read_plain(content: bytes) -> str:
    """Stands in for a PDF parser: the test files hold plain text."""
    return content.decode()


def _files(docs: DataFrame) -> DataFrame:
    suffix = F.when(F.col("lang") == "de", ".pdf").otherwise(".txt")
    name = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), suffix)
    return docs.select(
        F.col("doc_id").alias("paper_id"), name.alias("filename"), F.encode("text", "UTF-8").alias("content")
    )


INGESTED = """
SELECT d.doc_id AS id, d.source || '/' || d.doc_id || CASE WHEN lang = 'de' THEN '.pdf' ELSE '.txt' END AS title,
  CASE WHEN lang = 'de' THEN 'failed' ELSE 'processed' END AS ingest_status,
  CASE WHEN lang = 'de' THEN 'No parser for PDF files' END AS ingest_error,
  CASE WHEN lang = 'de' THEN 0 ELSE (SELECT count(*) FROM v_chunks c WHERE c.doc_id = d.doc_id) END AS n_chunks,
  CASE WHEN lang = 'de' THEN 0 ELSE (SELECT count(*) FROM v_doc_claims c WHERE c.doc_id = d.doc_id) END AS n_claims
FROM documents d"""

INGESTED_CLAIMS = """
SELECT c.doc_id AS paper_id, claim_index, 'cluster-0: ' || intervention || ' -> ' || outcome AS claim_key, population,
  intervention, outcome, result, study_type, confidence
FROM v_doc_claims c"""


@query(INGESTED)
def ingest_documents(spark, sf_dir):
    done = ingest.process_documents(_files(t.read(spark, sf_dir, "documents")), **RULES)
    return done.select(
        F.col("paper_id").alias("id"),
        F.col("filename").alias("title"),
        "ingest_status",
        "ingest_error",
        F.coalesce(F.array_size("chunks"), F.lit(0)).cast("bigint").alias("n_chunks"),
        F.coalesce(F.array_size("claims"), F.lit(0)).cast("bigint").alias("n_claims"),
    )


@query(INGESTED_CLAIMS)
def ingest_claims(spark, sf_dir):
    return ingest.ingest(_files(t.read(spark, sf_dir, "documents")), read_plain, **RULES)["claims"]


def _stream_documents(spark, sf_dir) -> str:
    """Run the ingestion stream over the documents table; the folder it wrote to."""
    schema = t.read(spark, sf_dir, "documents").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents*.parquet")
    root = scratch_dir(spark, "uploads")
    uploads.process_new_documents(_files(stream), root, f"{root}/_checkpoint", pdf_parser=read_plain, **RULES)
    return root


@query(INGESTED_CLAIMS)
def stream_claims(spark, sf_dir):
    return uploads.read_sink(spark, _stream_documents(spark, sf_dir), "claims")


@query(
    "SELECT doc_id || ':' || chunk_index AS chunk_id, doc_id AS paper_id, chunk_index, 'body' AS section, content, 256 AS width FROM v_chunks"
)
def stream_chunks(spark, sf_dir):
    """Chunks and their vectors, read from the sink that the stream wrote."""
    sink = uploads.read_sink(spark, _stream_documents(spark, sf_dir), "chunks")
    return sink.select("chunk_id", "paper_id", "chunk_index", "section", "content", F.size("embedding").alias("width"))


# --- studies --------------------------------------------------------------------------------

CTES["v_study_lines"] = """
SELECT p_partkey, CASE WHEN p_size < 5 THEN '{"population":"adults","intervention":"' || p_name || '"}'
  WHEN p_size < 10 THEN 'not json' WHEN p_size < 15 THEN
    '{"population":"adults","intervention":"' || p_name || '","outcome":"' || p_type || '","result":' || p_size || ',"study_type":"rct"}'
  ELSE '{"population":"adults","intervention":"' || p_name || '","outcome":"' || p_type || '","result":"positive","study_type":"rct"}'
  END AS value FROM part"""


def _study_lines(spark, sf_dir) -> DataFrame:
    size = F.col("p_size")
    head = F.concat(F.lit('{"population":"adults","intervention":"'), "p_name", F.lit('"'))
    outcome = F.concat(F.lit(',"outcome":"'), "p_type", F.lit('"'))
    line = (
        F.when(size < 5, F.concat(head, F.lit("}")))
        .when(size < 10, "not json")
        .when(size < 15, F.concat(head, outcome, F.lit(',"result":'), size.cast("string"), F.lit(',"study_type":"rct"}')))
        .otherwise(F.concat(head, outcome, F.lit(',"result":"positive","study_type":"rct"}')))
    )
    return t.read(spark, sf_dir, "part").select("p_partkey", line.alias("value"))


@query(
    """
SELECT row_number() OVER (ORDER BY p_partkey) AS id, p_partkey, value->>'population' AS population,
  value->>'intervention' AS intervention, value->>'outcome' AS outcome, value->>'result' AS result,
  value->>'study_type' AS study_type
FROM (SELECT p_partkey, CAST(value AS JSON) AS value FROM v_study_lines WHERE json_valid(value))
WHERE json_type(value, '$.outcome') = 'VARCHAR' AND json_type(value, '$.result') = 'VARCHAR'"""
)
def ingest_studies(spark, sf_dir):
    return sequential_ids(parse_studies(_study_lines(spark, sf_dir))[0], ["p_partkey"])


@query(
    """
SELECT p_partkey, value, CASE WHEN NOT json_valid(value) THEN 'not a JSON object'
  WHEN json_type(value, '$.outcome') IS NULL THEN 'not a string: outcome, result, study_type'
  ELSE 'not a string: result' END AS reason
FROM (SELECT p_partkey, value FROM v_study_lines)
WHERE NOT json_valid(value) OR json_type(value, '$.outcome') IS NULL OR json_type(value, '$.result') <> 'VARCHAR'"""
)
def refused_studies(spark, sf_dir):
    return parse_studies(_study_lines(spark, sf_dir))[1]


# --- snapshots and versions -----------------------------------------------------------------

RUN_TIMES = [datetime(y, 12, 31, tzinfo=timezone.utc) for y in (1995, 1996, 2001)]


def _bronze_run(spark, sf_dir, as_of: datetime) -> dict[str, DataFrame]:
    """Rows that one run exported, one per id."""
    run_id = bronze.make_run_id(as_of)
    claims = t.bronze_claims(spark, sf_dir).where(F.col("_run_id") == run_id)
    papers = t.bronze_papers(spark, sf_dir).where(F.col("_run_id") == run_id)
    return {"papers": papers, "claim_evidence": latest_versions(claims, F.lit(run_id), ties=t.CLAIM_TIES)}


def _write_runs(spark, sf_dir) -> str:
    root = scratch_dir(spark, "bronze")
    for as_of in RUN_TIMES:
        bronze.snapshot(spark, _bronze_run(spark, sf_dir, as_of), root, as_of)
    return root


@query("SELECT run_id, CAST(strptime(run_id, '%Y%m%dT%H%M%SZ') AS DATE) AS ingest_date, source_table, n_rows FROM v_runs"
       " UNION ALL SELECT '19961231T000000Z', DATE '1996-12-31', 'papers', 0")
def bronze_snapshots(spark, sf_dir):
    """Three exported runs; one of them has an empty papers table."""
    return bronze.run_history(spark, _write_runs(spark, sf_dir)).drop("exported_at")


@query(
    """
SELECT _run_id, _source_table, count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id FROM (
  SELECT id, _run_id, _source_table FROM v_bronze_claims WHERE _run_id <> '20011231T000000Z'
  QUALIFY row_number() OVER (PARTITION BY id, _run_id) = 1) GROUP BY 1, 2"""
)
def bronze_complete_runs(spark, sf_dir):
    """The last run crashed before its manifest, so its rows are not read."""
    root = scratch_dir(spark, "bronze")
    for as_of in RUN_TIMES[:2]:
        bronze.snapshot(spark, _bronze_run(spark, sf_dir, as_of), [root, scratch_dir(spark, "copy")], as_of)
    run_id = bronze.make_run_id(RUN_TIMES[2])
    rows = bronze.with_lineage(
        _bronze_run(spark, sf_dir, RUN_TIMES[2])["claim_evidence"],
        "claim_evidence",
        run_id,
        RUN_TIMES[2],
        schemas.SOURCE_COLUMNS["claim_evidence"],
    )
    rows.write.parquet(bronze.leaf_path(root, "claim_evidence", "2001-12-31", run_id))
    run_ids = bronze.complete_run_ids(spark, root)
    claims = bronze.read_bronze(spark, root, "claim_evidence", run_ids, strict=True)
    return claims.groupBy("_run_id", "_source_table").agg(
        F.count("*").alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query(
    """
SELECT _run_id, _source_table, count(*) AS n_rows, true AS same_bytes FROM (
  SELECT id, _run_id, _source_table FROM v_bronze_claims WHERE _run_id <> '20011231T000000Z'
  QUALIFY row_number() OVER (PARTITION BY id, _run_id) = 1) GROUP BY 1, 2"""
)
def bronze_copies(spark, sf_dir):
    """Two runs written to two targets: rows as the second one holds them, and whether its files are those of the first."""
    roots = [scratch_dir(spark, "bronze"), scratch_dir(spark, "copy")]
    for as_of in RUN_TIMES[:2]:
        bronze.snapshot(spark, _bronze_run(spark, sf_dir, as_of), roots, as_of)
    run_ids = bronze.complete_run_ids(spark, roots[1])
    claims = bronze.read_bronze(spark, roots[1], "claim_evidence", run_ids, strict=True)
    counts = claims.groupBy("_run_id", "_source_table").agg(F.count("*").alias("n_rows"))
    checks = [bronze.check_copy(spark, roots[1], r).withColumn("_run_id", F.lit(r)) for r in run_ids]
    found = reduce(DataFrame.unionByName, checks).withColumnRenamed("source_table", "_source_table").drop("files")
    return counts.join(found, ["_run_id", "_source_table"])


HASHED = ("paper_id", "claim_key", "population", "intervention", "outcome", "result", "study_type", "confidence")

CTES["v_old_state"] = """
SELECT * FROM v_bronze_claims WHERE _run_id <> '20011231T000000Z'
QUALIFY row_number() OVER (PARTITION BY id ORDER BY _exported_at DESC, _run_id DESC, _price, _part, _supplier) = 1"""
CTES["v_new_state"] = """
SELECT * FROM v_bronze_claims WHERE _run_id <> '19951231T000000Z'
QUALIFY row_number() OVER (PARTITION BY id ORDER BY _exported_at DESC, _run_id DESC, _price, _part, _supplier) = 1"""
SAME = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in HASHED)


def _state(spark, sf_dir, without_run: str) -> DataFrame:
    rows = t.bronze_claims(spark, sf_dir).where(F.col("_run_id") != without_run)
    latest = latest_versions(rows, F.lit(t.LATEST_RUN), ties=t.CLAIM_TIES)
    return latest.select("id", *HASHED, C.row_hash(HASHED).alias("row_hash"))


@query(
    f"""
SELECT coalesce(n.id, o.id) AS id, CASE WHEN o.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'kept'
  WHEN {SAME} THEN 'unchanged' ELSE 'update' END AS change
FROM v_new_state n FULL JOIN v_old_state o ON n.id = o.id"""
)
def upsert_changes(spark, sf_dir):
    old, new = _state(spark, sf_dir, t.LATEST_RUN), _state(spark, sf_dir, t.FIRST_RUN)
    return versions.classify_changes(old, new, "id")


def _upserted(spark, sf_dir, *without_runs: str) -> tuple[str, list[dict]]:
    """A table after one upsert per state, and what each of them did."""
    path = scratch_dir(spark, "upserts")
    return path, [versions.upsert(_state(spark, sf_dir, run), path, "id") for run in without_runs]


STATE_COLUMNS = ", ".join(("id", *HASHED))


@query(
    f"SELECT {STATE_COLUMNS} FROM v_new_state UNION ALL "
    f"SELECT {STATE_COLUMNS} FROM v_old_state WHERE id NOT IN (SELECT id FROM v_new_state)"
)
def upserted_table(spark, sf_dir):
    path, _ = _upserted(spark, sf_dir, t.LATEST_RUN, t.FIRST_RUN)
    return versions.read_table(spark, path).select("id", *HASHED)


@query(f"SELECT {STATE_COLUMNS} FROM v_old_state")
def table_after_first_upsert(spark, sf_dir):
    path, _ = _upserted(spark, sf_dir, t.LATEST_RUN)
    return versions.read_table(spark, path).select("id", *HASHED)


@query(
    f"""
SELECT change, count(*) AS n FROM (
  SELECT CASE WHEN o.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'kept' WHEN {SAME} THEN 'unchanged' ELSE 'update' END AS change
  FROM v_new_state n FULL JOIN v_old_state o ON n.id = o.id) GROUP BY change"""
)
def upsert_change_counts(spark, sf_dir):
    """What an upsert of the newer state does to the stored older one."""
    path, _ = _upserted(spark, sf_dir, t.LATEST_RUN)
    stored = versions.read_table(spark, path)
    return versions.classify_changes(stored, _state(spark, sf_dir, t.FIRST_RUN), "id").groupBy("change").agg(F.count("*").alias("n"))


STREAMED = list(vocab.CLAIM_HASH_COLUMNS)


def _valid_now(spark, silver_root: str) -> DataFrame:
    """Stored claims that still pass. Claims rejected by now keep their last valid state in the
    table, as upserts never delete; they are left out here."""
    tables = pipeline.read_silver(spark, silver_root)
    # Merged: by the bytes of its files, millions of ids would be broadcast.
    rejected = tables["claims_rejects"].select("claim_id").hint("merge")
    return tables["claims"].join(rejected, "claim_id", "left_anti").select("claim_id", *STREAMED)


@query(f"SELECT claim_id, {', '.join(STREAMED)} FROM v_valid")
def batch_silver(spark, sf_dir):
    """All runs at once: snapshots, manifests, newest versions, checks and commits."""
    silver_root = scratch_dir(spark, "silver")
    pipeline.run_bronze_to_silver(spark, _write_runs(spark, sf_dir), silver_root)
    return _valid_now(spark, silver_root)


@query(f"SELECT claim_id, {', '.join(STREAMED)} FROM v_valid")
def stream_silver(spark, sf_dir):
    """Silver kept up to date run by run."""
    bronze_root, silver_root = scratch_dir(spark, "bronze"), scratch_dir(spark, "silver")
    for as_of in RUN_TIMES:
        bronze.snapshot(spark, _bronze_run(spark, sf_dir, as_of), bronze_root, as_of)
        run_stream.process_new_runs(spark, bronze_root, silver_root, f"{silver_root}/_checkpoint")
    return _valid_now(spark, silver_root)
