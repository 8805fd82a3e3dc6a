"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, decontam, interactions, language_id, maxscore, near_dup, packing, pii, quality, secret_scan, store, toxicity, url_filter, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url's host, path, rule, verdict and score; the model is fitted on the module's labelled urls."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.fit(url_filter.seed(spark)))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; learnt from rows whose crc32(doc_id) mod 5 is not 0."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(_remainder(5) != 0))
    got = docs.withColumn("j", language_id.predict(docs, model))
    return got.select("doc_id", (_remainder(5) == 0).alias("held_out"), "j.lang_pred", "j.score", "j.ambiguous")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; learnt from labels whose crc32(doc_id) mod 3 is not 1."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(_remainder(3) != 1))
    got = docs.withColumn("score", toxicity.score(docs, model))
    return got.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of base spans, and all spans."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    got = docs.withColumn("p", pii.detect(docs, pii.fit(docs)))
    count = lambda kind: F.size(F.filter("p.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return got.select("doc_id", *map(count, pii.BASE_KINDS), "p.base_sha256", F.col("p.joined").alias("spans"), F.size("p.spans").cast("long").alias("n_spans"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors of every 20th id, against all."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", maxscore.quantized(F.col("embedding")).alias("v"))
    return maxscore.top_k(rows.where(F.col("vec_id") % 20 == 0), rows, 20)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it contains."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contained(docs, _read(spark, sf_dir, "benchmark").select("item_id", "text"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near copies; none for texts without words."""
    return near_dup.classes(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 low quality, 1 good but toxic, 2 good; learnt from rows whose crc32(doc_id) mod 5 is not 0."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _read(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * (2 - F.coalesce("toxic", F.lit(0)))).alias("grade"))
    model = quality.fit(docs, labels.where(_remainder(5) != 0), 3)
    got = docs.withColumn("r", quality.rate(docs, model))
    return got.select("doc_id", (_remainder(5) == 0).alias("held_out"), F.col("r.expected").alias("expected_grade"), F.col("r.tail")[0].alias("p_good"), (F.col("r.tail")[0] >= 0.5).alias("keep"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of the documents' tokens in sequences of at most 4096."""
    return packing.pack(_read(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it is read back from archives; gaps go to a log in the shared folder."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = store.scratch(spark, "warc")
    warc.write(pages, path)
    number = lambda header: F.regexp_extract(F.col("headers")[header], "<urn:page:(-?[0-9]+)>", 1).try_cast("long")
    read = store.pinned(warc.read(spark, path).drop("payload"))
    warc.log_gaps(read, store.scratch(spark, "warc-gaps"))
    got = read.where(F.col("problem").isNull())
    size = F.when(F.col("type") == "revisit", F.col("headers")["x-payload-length"].cast("long")).otherwise(F.col("payload_bytes"))
    digest = F.when(F.col("type") == "revisit", F.substring(F.col("headers")["warc-payload-digest"], 6, 40)).otherwise(F.col("payload_digest"))
    return got.select(number("warc-record-id").alias("page_id"), size.alias("payload_bytes"), digest.alias("payload_digest"), F.col("type").alias("record_type"), number("warc-refers-to").alias("refers_to"))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at each step of their 120 orders, by language."""
    docs, labels = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), _read(spark, sf_dir, "labels")
    return interactions.audit(docs, labels).drop("filter").withColumnsRenamed({"lost_good": "good_lost", "lost_toxic": "toxic_lost"})


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: counts and digest of base spans, and all spans."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    got = docs.withColumn("p", secret_scan.scan(docs, secret_scan.fit(docs)))
    count = lambda kind: F.size(F.filter("p.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return got.select("doc_id", *map(count, secret_scan.BASE_KINDS), "p.base_sha256", F.col("p.joined").alias("spans"), F.size("p.spans").cast("long").alias("n_spans"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 64-component vector's cluster after three rounds from 16 starts, with distances and sums."""
    found, centres = centroids.clusters(centroids.kept_vectors(_read(spark, sf_dir, "embeddings")))
    return centroids.with_inertia(found, centres).withColumnRenamed("key", "vec_id")


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM m
"""

OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, good, toxic,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(first < doc_id, FALSE)::INT AS mask
  FROM d LEFT JOIN l USING (doc_id)),
m AS (SELECT part, mask, count(*) AS n, count_if(coalesce(good, FALSE)) AS good, count_if(coalesce(toxic, FALSE)) AS toxic FROM f GROUP BY part, mask),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([0, 1, 2, 3, 4]) AS bit),
p AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a JOIN x b ON b.c <> a.c JOIN x c ON c.c NOT IN (a.c, b.c) JOIN x d ON d.c NOT IN (a.c, b.c, c.c)
  JOIN x e ON e.c NOT IN (a.c, b.c, c.c, d.c)),
s AS (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM p),
g AS (SELECT filter_order, step, bits, bits[step] AS f, list_sum(list_transform(bits[1:step - 1], lambda b: 1 << b)) AS seen FROM s),
r AS (
  SELECT part, filter_order, step, f, (mask >> f) & 1 AS fails, mask & coalesce(seen, 0)::INT AS gone, mask, n, good, toxic FROM g CROSS JOIN m),
t AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN fails = 0 AND gone = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails = 1 AND gone = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails = 1 AND gone <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = 1 << f THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails = 1 AND gone = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails = 1 AND gone = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM r GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM t
"""


def _clusters_sql(k: int = 16, rounds: int = 3, size: int = 64) -> str:
    """SQL of op13: every round is one assignment to all centroids and one mean by cluster and component."""
    parts = [f"""WITH v AS (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
h AS (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, v) - 1 AS c FROM v),
c0 AS (SELECT CAST(c AS INTEGER) AS c, v FROM h WHERE c < {k})"""]
    near = "SELECT v.i, any_value(v.vec_id) AS vec_id, any_value(v.v) AS v, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), c := c.c)) AS best FROM v CROSS JOIN c{r} c GROUP BY v.i"
    for r in range(rounds):
        parts.append(f"a{r} AS ({near.format(r=r)})")
        parts.append(f"u{r} AS (SELECT best.c AS c, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM a{r})")
        parts.append(f"w{r} AS (SELECT c, j, CAST((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM u{r} GROUP BY c, j)")
        parts.append(f"m{r} AS (SELECT c, list(x ORDER BY j) AS v FROM w{r} GROUP BY c)")
        parts.append(f"c{r + 1} AS (SELECT c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} USING (c))")
    parts.append(f"z AS ({near.format(r=rounds)})")
    return ",\n".join(parts) + f"""
SELECT z.vec_id, z.best.c AS cluster, z.best.d AS distance, CAST(sum(z.best.d) OVER (PARTITION BY z.best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(z.best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM z JOIN c{rounds} c ON c.c = z.best.c
"""


OP13_SQL = _clusters_sql()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_url_filter, op2_language_id, op3_toxicity, op4_pii, op5_exact_top_k, op6_decontamination, op7_near_duplicates, op8_quality, op9_packing, op10_warc, op11_filter_interactions, op12_secret_scan, op13_centroid_clusters)}
ORACLE_SQL: dict[str, str] = {"op5_exact_top_k": OP5_SQL, "op10_warc": OP10_SQL, "op11_filter_interactions": OP11_SQL, "op13_centroid_clusters": OP13_SQL}
