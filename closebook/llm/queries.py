"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.llm import chat, decontaminate, language, licenses, mixing, quality, search, sharding, simhash, tokens, toxicity, vectors, whitening
from closebook.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


# Every pair of a label, and reachability by following links.
ORACLES["op4_embedding_dedup"] = r"""
WITH RECURSIVE vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM vectors
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
links AS (
  SELECT a.vec_id AS one, b.vec_id AS other FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
),
reached AS (
  SELECT vec_id AS root, vec_id AS node FROM vectors
  UNION
  SELECT r.root, l.other FROM reached r JOIN links l ON l.one = r.node
),
counted AS (SELECT one, count(*) AS n FROM links GROUP BY one),
grouped AS (SELECT root, min(node) AS component_id FROM reached GROUP BY root)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, g.component_id, v.vec_id = g.component_id AS kept
FROM vectors v JOIN grouped g ON g.root = v.vec_id LEFT JOIN counted c ON c.one = v.vec_id
"""


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    found = decontaminate.find(docs.select("doc_id", "text"), benchmark)
    spans, items = F.col("contamination.spans"), F.col("contamination.items")
    listed = F.concat_ws(",", F.array_sort(F.transform(items, lambda i: i.cast("string"))))
    return found.select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        decontaminate.n_hit(spans).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"),
    )


# Words of the documents and windows of the items; every occurrence marks the words it covers.
ORACLES["op9_decontaminate"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM g), s AS (
  SELECT r, n, k, array_to_string(w[k : k + n - 1], ' ') AS gram
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
), hit AS (SELECT s.r, s.k, s.n, g.item_id FROM s JOIN g ON g.n = s.n AND g.gram = s.gram),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT r, k, n FROM hit)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokens.read(tokens.write(docs, tokens.new_folder(docs), public_tokenizers.path("byte_bpe_50k.json")))


@query
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.shares(table(spark, sf_dir, "documents"))
    return found.withColumn("target", F.round("target", 6))


# The level that targets follow is found by trying every source as the first one that is not stopped.
ORACLES["op2_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(text, '')) AS tie,
    coalesce(0.25::DOUBLE + 0.75::DOUBLE * (length(regexp_replace(text, '[^\p{L}]+', '', 'g'))::DOUBLE / nullif(length(text), 0)), 0.25::DOUBLE) AS w
  FROM documents
), k AS (
  SELECT *, -ln((('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || tie), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / w AS key FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS weight
  FROM k GROUP BY source
), t AS (
  SELECT *, 3.0::DOUBLE * source_size AS most, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS place FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM t
), g AS (
  SELECT source, source_size, least(most, weight * (SELECT arg_min(level, place) FROM l WHERE most / weight >= level)) AS target FROM l
), p AS (
  SELECT k.*, source_size, target, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size::BIGINT AS size, source_size, round(target, 6) AS target,
  (epochs * size + greatest(0, least(size, round(target - epochs * source_size)::BIGINT - before)))::BIGINT AS taken FROM p
"""


@query
def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.manifest(table(spark, sf_dir, "documents"))


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.inline(F.expr("array(struct(0L AS turn, 'user' AS role), struct(1L AS turn, 'assistant' AS role))")),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    read = chat.read_chats(chat.format_chats(rows.unionByName(extra)))
    said = F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# Formatted length: the escaped texts, 3 per mark between turns of one role, and the marks and roles around each run.
ORACLES["op8_chat_format"] = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'), '([<\[])(/?(?:[str]>|INST\]|OUT\]))', '\1\\\2', 'g')) AS n,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS DISTINCT FROM role AS opens FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n + CASE WHEN NOT opens THEN 3 WHEN role = 'assistant' THEN length(role) + 21 ELSE length(role) + 23 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("spans", lambda s: s["start"].cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("spans").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.col("license_score").alias("score"),
    )




@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.fold("doc_id", 4) == 2)
    filters = language.fit(docs.filter("NOT held_out"), "text", "lang", ["doc_id"])
    return language.predict(docs.select("doc_id", "held_out", "text"), filters)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = language.fold("doc_id", 3) == 1
    model = toxicity.fit(docs, labels.filter(~held_out))
    found = toxicity.score(docs.select("doc_id", "text"), model).withColumn("held_out", held_out)
    score = F.col("toxicity.score")
    return found.select("doc_id", "held_out", score.alias("score"), (score >= toxicity.REJECT).cast("int").alias("predicted"))


@query
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = language.fold("doc_id", 3) == 1
    model = quality.fit(docs, labels.filter(~held_out))
    found = quality.score(docs.select("doc_id", "text"), model).withColumn("held_out", held_out)
    score = F.col("quality.score")
    return found.select("doc_id", "held_out", score.alias("score"), (score >= quality.ACCEPT).cast("int").alias("predicted"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    values = F.posexplode(F.arrays_zip("whitened", "explained"))
    return found.select("vec_id", "n", "deviation", "identity_error", values.alias("place", "value")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("value.whitened").alias("whitened"),
        F.col("value.explained").alias("explained"),
        "identity_error",
    )


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return search.rank(docs, benchmark)


ORACLES["op13_ranked_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), t AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term
), c AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS length FROM d WHERE len(w) > 0), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), f AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM t, c GROUP BY term, docs
), m AS (
  SELECT r, doc_id, 50 + (50 * len(w)::BIGINT * docs) // length AS middle FROM d, c WHERE len(w) > 0
), s AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * middle)))::BIGINT AS score
  FROM t JOIN i USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY item_id, r
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
) WHERE rank <= 50
"""
