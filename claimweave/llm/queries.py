"""The registered queries of the operators and their reference SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from claimweave.llm import (
    bpe,
    chat,
    embeddings,
    importance,
    language_model,
    merge_replay,
    mixing,
    quality,
    secrets,
    simhash,
    toxicity,
    vector_codes,
    warc,
)
from claimweave.llm.base import ORACLES, QUERIES, query, read, whole_text
from claimweave.session import scratch_dir, staged

# --- 10: quality rules -----------------------------------------------------------------------

WORD_SQL = r"[\x20\x09-\x0D]+"

QUALITY_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, lang, source, coalesce(text, '') AS body FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(body, '{WORD_SQL}'), lambda w: w <> '') AS words,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (
  SELECT row_no, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT row_no, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
covered AS (
  SELECT row_no, count(DISTINCT i + k) AS n FROM (
    SELECT row_no, i, unnest([0, 1, 2]) AS k
    FROM windows JOIN (SELECT row_no, gram FROM windows GROUP BY ALL HAVING count(*) > 1) USING (row_no, gram))
  GROUP BY row_no),
counted AS (
  SELECT doc_id, lang, source, row_no, len(words) AS n_words,
    length(regexp_replace(body, '{WORD_SQL}', '', 'g')) AS word_chars,
    len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (row_no)),
valued AS (
  SELECT row_no, lang, source, unnest([
    {{'measure': 'word_length', 'value': 20 * word_chars // n_words}},
    {{'measure': 'symbol_share', 'value': 1000 * n_symbols // word_chars}},
    {{'measure': 'dup_line_share', 'value': 1000 * n_dup_lines // n_lines}},
    {{'measure': 'repeat_share', 'value': 1000 * n_repeat_words // n_words}}], recursive := true)
  FROM counted WHERE n_words > 0),
quartiles AS (
  SELECT lang, source, measure, grouping(lang) + grouping(source) AS level, count(*) AS docs,
    quantile_disc(value, 0.25) AS lower, quantile_disc(value, 0.75) AS upper
  FROM valued GROUP BY GROUPING SETS ((lang, source, measure), (lang, measure), (measure))),
judged AS (
  SELECT v.row_no, bool_or(value > upper + 4 * (upper - lower) + slack
      OR (measure = 'word_length' AND value < lower - 4 * (upper - lower) - slack)) AS outside
  FROM valued v
  JOIN (VALUES ('word_length', 30), ('symbol_share', 50), ('dup_line_share', 400), ('repeat_share', 350)) AS s(measure, slack)
    USING (measure)
  JOIN quartiles q ON q.measure = v.measure
    AND q.lang IS NOT DISTINCT FROM CASE WHEN q.level < 2 THEN v.lang END
    AND q.source IS NOT DISTINCT FROM CASE WHEN q.level = 0 THEN v.source END
  JOIN (SELECT lang, source, measure, docs AS own FROM quartiles WHERE level = 0) a
    ON a.measure = v.measure AND a.lang IS NOT DISTINCT FROM v.lang AND a.source IS NOT DISTINCT FROM v.source
  JOIN (SELECT lang, measure, docs AS of_lang FROM quartiles WHERE level = 1) b
    ON b.measure = v.measure AND b.lang IS NOT DISTINCT FROM v.lang
  WHERE q.level = CASE WHEN own >= 200 THEN 0 WHEN of_lang >= 200 THEN 1 ELSE 2 END
  GROUP BY v.row_no)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT coalesce(outside, false) AS kept
FROM counted LEFT JOIN judged USING (row_no)"""


@query(QUALITY_SQL)
def op10_quality_rules(spark, sf_dir):
    counted = staged(quality.measure(read(spark, sf_dir, "documents")).drop("text"), "measured")
    return quality.judge(counted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


# --- 1: secret scans --------------------------------------------------------------------------


@query()
def op1_secret_scan(spark, sf_dir):
    found = secrets.scan_versions(read(spark, sf_dir, "documents"), scratch_dir(spark, "ledger"))
    base = [r.kind for r in secrets.BASE_RULES]

    def listed(spans):
        named = F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        )
        return F.array_join(named, ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(listed(of(*base)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


# --- 7: chat formatting -----------------------------------------------------------------------

CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
  UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
rendered AS (
  SELECT *, replace(replace(body, '\', '\b'), '<', '\l') AS escaped,
    replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g') AS mark FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn, role, escaped)) AS turns_sha256,
  CAST(coalesce(sum(length(body)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(body, '' ORDER BY turn, role, escaped) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(escaped) + length(mark) + 15) AS BIGINT) AS formatted_chars
FROM rendered GROUP BY conv_id"""


@query(CHAT_SQL)
def op7_chat_formatting(spark, sf_dir):
    probe = spark.sql(
        r"SELECT -7L AS conv_id, t AS turn, r AS role, r'\### Assistant: </turn> ok' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)"
    )
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = chat.format_conversations(given.unionByName(probe))
    lines = F.transform(
        chat.turns_of(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    read_back = out.select(
        "conv_id",
        lines.alias("lines"),
        chat.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    return read_back.select(
        "conv_id",
        F.size("lines").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("lines", ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


# --- 9: toxicity ------------------------------------------------------------------------------


def fold(column: str, folds: int):
    return F.crc32(F.col(column).cast("string")) % folds


@query()
def op9_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    seen = ~fold("doc_id", 4).eqNullSafe(2)
    labels = read(spark, sf_dir, "labels").where(seen).select("doc_id", "toxic")
    model = toxicity.learn(docs.where(seen), labels)
    return toxicity.score(docs, model).select(
        "doc_id",
        fold("doc_id", 4).eqNullSafe(2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


# --- 5: WARC ----------------------------------------------------------------------------------


@query()
def op5_warc_archive(spark, sf_dir):
    folder = scratch_dir(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), folder, shard_bytes=16 << 20, file_bytes=4 << 20)
    records = staged(
        warc.read_archive(spark, folder).select(
            "id", "kind", "refers", "digest", F.octet_length("payload").cast("bigint").alias("stored")
        ),
        "records",
    )
    # A revisit holds no payload: its length is that of the response it refers to.
    responses = (
        records.where("kind = 'response'")
        .groupBy(F.col("id").alias("of"), F.col("digest").alias("same"))
        .agg(F.first("stored").alias("full"))
    )
    joined = records.join(
        responses,
        (F.col("kind") == "revisit") & F.col("refers").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")),
        "left",
    )
    return joined.select(
        F.col("id").alias("page_id"),
        F.coalesce("full", "stored").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").alias("refers_to"),
    )


# --- 6: BPE -----------------------------------------------------------------------------------


def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op6_bpe_round_trip(spark, sf_dir):
    table = vocabulary()
    encoded = bpe.encode(read(spark, sf_dir, "documents"), table)
    return bpe.decode(encoded, table).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


# --- 4: language-model scores -----------------------------------------------------------------


@query()
def op4_lm_scoring(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = language_model.score_texts(docs, ~fold("doc_id", 5).eqNullSafe(1))
    return scored.select(
        "doc_id",
        fold("doc_id", 5).eqNullSafe(1).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


# --- 2: SimHash near duplicates ---------------------------------------------------------------


@query()
def op2_simhash_near_dup(spark, sf_dir):
    linked = simhash.link_fingerprints(read(spark, sf_dir, "documents"))
    return linked.select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


# --- 3: embedding near duplicates -------------------------------------------------------------


@query()
def op3_embedding_near_dup(spark, sf_dir):
    linked = embeddings.link_vectors(read(spark, sf_dir, "embeddings"))
    return linked.select(
        "vec_id",
        "n_links",
        F.col("component").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"),
    )


# --- 8: mixing to target weights --------------------------------------------------------------

MIX_TARGETS = {
    "source": {f"src{i}": 6.0 if i == 0 else 1.0 for i in range(20)},
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    "topic": {"prose": 0.94, "notice": 0.03, "contact": 0.03},
}
MIX_ROUNDS = 20
# The share of the tokens that the pipeline draws.
MIX_KEEP = 0.5


def topic(text: str):
    """A document's topic by marks in its text."""
    body = whole_text(text)
    return (
        F.when(F.contains(body, F.lit("icense")), "notice").when(F.contains(body, F.lit("@")), "contact").otherwise("prose")
    )


def mix_sql() -> str:
    """The same raking as a chain of named steps, three for each round."""

    def place(column, names):
        return f"coalesce(list_position([{', '.join(repr(n) for n in names)}], {column}), 0)"

    dims = list(MIX_TARGETS)
    values = {
        "source": "source",
        "lang": "lang",
        "topic": "CASE WHEN contains(body, 'icense') THEN 'notice' WHEN contains(body, '@') THEN 'contact' ELSE 'prose' END",
    }
    steps = [
        "docs AS (SELECT doc_id, source, lang, coalesce(text, '') AS body FROM documents)",
        "counted AS (SELECT doc_id, "
        + ", ".join(f"{place(values[d], MIX_TARGETS[d])} AS at_{d}" for d in dims)
        + ", len(regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+')) AS tokens FROM docs)",
        "cells AS (SELECT " + ", ".join(f"at_{d}" for d in dims) + ", sum(tokens) AS tokens FROM counted GROUP BY ALL)",
    ]
    for d in dims:
        weights = ", ".join(f"({i + 1}, {w}::DOUBLE)" for i, w in enumerate(MIX_TARGETS[d].values()))
        steps.append(
            f"goal_{d} AS (SELECT at_{d}, CASE WHEN at_{d} = 0 THEN own ELSE "
            f"coalesce(w, 0) / sum(coalesce(w, 0)) OVER () * (1 - coalesce(max(own) FILTER (at_{d} = 0) OVER (), 0)) END AS goal "
            f"FROM (SELECT at_{d}, sum(tokens)::DOUBLE / (SELECT sum(tokens) FROM cells) AS own FROM cells GROUP BY 1) "
            f"LEFT JOIN (VALUES {weights}) AS t(place, w) ON place = at_{d})"
        )
    last = "s0"
    steps.append("s0 AS (SELECT *, tokens::DOUBLE / sum(tokens) OVER () AS share FROM cells)")
    for n in range(MIX_ROUNDS):
        for d in dims:
            name = f"s{n}_{d}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT c.* EXCLUDE (share), share * goal / sum(share) OVER (PARTITION BY c.at_{d}) AS share "
                f"FROM {last} c JOIN goal_{d} g ON c.at_{d} = g.at_{d})"
            )
            last = name
    on = " AND ".join(f"r.at_{d} = k.at_{d}" for d in dims)
    steps.append(f"rated AS (SELECT *, share / tokens / max(share / tokens) OVER () AS rate FROM {last})")
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT doc_id, CAST(k.tokens AS BIGINT) AS tokens, round(share, 9) AS weight, "
        "round(rate, 9) AS rate, ('0x' || substr(md5('mix:' || doc_id), 1, 12))::BIGINT / 281474976710656.0 < rate AS kept "
        f"FROM counted k JOIN rated r ON {on}"
    )


@query(mix_sql())
def op8_mix_weights(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    levels = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic("text")}
    return mixing.plan(docs, levels, MIX_TARGETS, rounds=MIX_ROUNDS).select(
        "doc_id",
        F.col("mix_tokens").alias("tokens"),
        F.round("mix_weight", 9).alias("weight"),
        F.round("mix_rate", 9).alias("rate"),
        F.col("mix_kept").alias("kept"),
    )


# --- 11: vector codes -------------------------------------------------------------------------


def vector_code_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Every part against every entry, a step for each round."""
    nearest = (
        "SELECT place, part, min(d * {n} + entry) % {n} AS entry, min(d) AS d FROM (SELECT p.place, part, b.entry, "
        "list_sum(list_transform(list_zip(p.xs, b.xs), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d "
        "FROM cut p JOIN {books} b USING (part)) GROUP BY ALL"
    )
    steps = [
        "kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS place, vec_id, label, "
        "list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"cut AS (SELECT place, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS xs "
        f"FROM kept, range({parts}) AS r(part))",
        f"b0 AS (SELECT part, place - 1 AS entry, xs FROM cut WHERE place <= {entries})",
    ]
    for n in range(rounds):
        steps += [
            f"n{n} AS ({nearest.format(books=f'b{n}', n=1000)})",
            f"m{n} AS (SELECT part, entry, list((total // n - CASE WHEN total % n < 0 THEN 1 ELSE 0 END)::BIGINT ORDER BY i) AS xs "
            f"FROM (SELECT part, entry, i, sum(xs[i])::BIGINT AS total, count(*) AS n FROM (SELECT part, entry, xs, "
            f"unnest(range(1, len(xs) + 1)) AS i FROM n{n} JOIN cut USING (place, part)) GROUP BY ALL) GROUP BY ALL)",
            f"b{n + 1} AS (SELECT part, entry, coalesce(m.xs, b.xs) AS xs FROM b{n} b LEFT JOIN m{n} m USING (part, entry))",
        ]
    steps += [
        f"coded AS (SELECT place, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error "
        f"FROM ({nearest.format(books=f'b{rounds}', n=1000)}) GROUP BY place)",
        f"digest AS (SELECT sha256(string_agg(array_to_string(xs, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})",
    ]
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, "
        "codebooks_sha256 FROM kept JOIN coded USING (place), digest"
    )


@query(vector_code_sql())
def op11_vector_codes(spark, sf_dir):
    coded, books = vector_codes.encode_vectors(read(spark, sf_dir, "embeddings"))
    return vector_codes.group_errors(coded).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.codebook_digest(books)).alias("codebooks_sha256"),
    )


# --- 12: importance resampling ----------------------------------------------------------------

IMPORTANCE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT b, b::BIGINT AS rest, 0 AS step FROM range(256) AS r(b)
  UNION ALL SELECT b, CASE WHEN rest % 2 = 1 THEN xor(rest >> 1, 3988292384) ELSE rest >> 1 END, step + 1 FROM bits WHERE step < 8),
remainders AS (SELECT list(rest ORDER BY b) AS rests FROM bits WHERE step = 8),
texts AS (
  SELECT row_number() OVER () AS row_no, * FROM (
    SELECT true AS aim, item_id AS id, text FROM benchmark UNION ALL SELECT false, doc_id, text FROM documents)),
words AS (
  SELECT row_no, aim, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts),
features AS (
  SELECT row_no, aim, array_to_string(ws[i:i + n], ' ') AS feature FROM (
    SELECT *, unnest(range(1, len(ws) - n + 1)) AS i FROM words, range(3) AS r(n))),
spelled AS (
  SELECT feature, hex(encode(feature)) AS spelling FROM (SELECT DISTINCT feature FROM features)),
hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(spelling), 2),
      lambda i: ('0x' || substr(spelling, i, 2))::BIGINT)),
    lambda crc, b: xor(crc >> 8, rests[xor(crc & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM spelled, remainders),
found AS (SELECT row_no, aim, bucket FROM features JOIN hashed USING (feature)),
sums AS (
  SELECT bucket, count(*) FILTER (aim) AS t, count(*) FILTER (NOT aim) AS s FROM found GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM sums) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sums) + 10000)::DOUBLE)))::BIGINT AS gain FROM sums),
weighed AS (SELECT row_no, count(*) AS n, sum(gain)::BIGINT AS gain FROM found JOIN gains USING (bucket) GROUP BY row_no),
scored AS (
  SELECT id AS doc_id, coalesce(n, 0) AS n_features, coalesce(gain, 0) AS weight, len(ws) >= 20 AS fit,
    coalesce(gain, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weighed USING (row_no) WHERE NOT aim),
placed AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN fit AND place <= 5 * (SELECT count(*) FROM scored WHERE fit) // 100 THEN place END AS rank
FROM placed"""


@query(IMPORTANCE_SQL)
def op12_importance_resample(spark, sf_dir):
    drawn = importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# --- 13: merge replay -------------------------------------------------------------------------


@query()
def op13_merge_replay(spark, sf_dir):
    ranks = merge_replay.Ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = merge_replay.encode(read(spark, sf_dir, "documents"), ranks, pattern=public_tokenizers.PATTERN)
    return merge_replay.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
