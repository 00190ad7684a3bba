"""One query per training-data operator, over its whole table, with DuckDB SQL where SQL can say it."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simpairs.llm import exact_dedup, fingerprints, hard_negatives, lexical_search, line_dedup, mixing, near_dedup, packing, pii, quality, sharding, simhash, suffix_dedup
from simpairs.llm.common import documents, text_bytes

#: where the tokenizer files are; a parameter of the operators, never part of the repository
TOKENIZER = "byte_bpe_50k.json"

#: the secret of the pseudonyms; a deployment passes its own
PII_KEY = "corpus-pseudonyms"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


@_query("op10_exact_dedup", r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


@_query("op8_near_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS r FROM s UNION SELECT l.b, reach.r FROM reach JOIN links l ON reach.doc_id = l.a),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(sh) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)""")
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir).select("doc_id", "text"), words=4)


@_query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.classify(documents(spark, sf_dir).select("doc_id", "text"), labels.select("doc_id", "quality"))


@_query("op5_source_mixing")
def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.place(documents(spark, sf_dir).select("doc_id", "source"))


@_query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path())


@_query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                        F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@_query("op4_document_fingerprints")
def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return fingerprints.compare(docs, text_bytes(docs))


@_query("op6_sharding", """
WITH r AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS b,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
n AS (
  SELECT d, h >> (60 - d) AS p, sum(b)::BIGINT AS shard_bytes, count(*) AS shard_rows
  FROM r, (SELECT unnest(range(0, 61))::INTEGER AS d) GROUP BY ALL),
f AS (
  SELECT r.doc_id, n.*, row_number() OVER (PARTITION BY r.doc_id ORDER BY n.d) AS k
  FROM r JOIN n ON r.h >> (60 - n.d) = n.p WHERE n.shard_bytes <= 1048576 OR n.d = 60)
SELECT doc_id, CASE WHEN d = 0 THEN '' ELSE lpad(bin(p), d, '0') END AS shard, d::BIGINT AS depth, shard_bytes, shard_rows,
       shard_bytes <= 1048576 AS fits FROM f WHERE k = 1""")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.col("__shard").alias("shard"), F.col("__depth").cast("long").alias("depth"),
                        F.col("__shard_bytes").alias("shard_bytes"), F.col("__shard_rows").alias("shard_rows"),
                        F.col("__fits").alias("fits"))


@_query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), PII_KEY, found_col="kinds")
    return found.withColumn("n_replaced", F.size("kinds").cast("long"))


@_query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_links").alias("n_links"),
                      F.size("__removed").cast("long").alias("n_removed"), F.col("__removed").alias("removed"),
                      F.sha2("text", 256).alias("kept_sha256"))


@_query("op11_simhash_dedup")
def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir).select("doc_id", "text"))


@_query("op12_hard_negatives", """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS k
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 3""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 50 == 0)


@_query("op13_lexical_search", r"""
WITH x AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
d AS (SELECT r, doc_id, len(ws) AS n, ws FROM x WHERE len(ws) > 0),
s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nl FROM d),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ws) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
sc AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // nl)))) AS BIGINT) AS score
  FROM i JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS k FROM sc WHERE score > 0) WHERE k <= 10""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return lexical_search.search(documents(spark, sf_dir).select("doc_id", "text"), items.select("item_id", "text"))
