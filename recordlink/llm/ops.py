"""The operators on their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlink.llm.alignment import align_tokens
from recordlink.llm.decontamination import decontaminate
from recordlink.llm.exact_dedup import exact_dedup
from recordlink.llm.lexical_search import lexical_search
from recordlink.llm.line_dedup import line_dedup
from recordlink.llm.mixing import mix_sources
from recordlink.llm.near_dedup import near_dedup
from recordlink.llm.packing import pack_documents
from recordlink.llm.quality import score_quality
from recordlink.llm.queries import query, read
from recordlink.llm.secrets import scan_secrets
from recordlink.llm.substring_dedup import substring_dedup
from recordlink.llm.topk_search import top_k
from recordlink.llm.toxicity import score_toxicity

OP1_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score
  FROM usable q JOIN usable p ON q.vec_id % 100 = 0 AND p.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP4_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT doc_id, sha256(t) AS h, max(doc_id) OVER (PARTITION BY t) AS k, count(*) OVER (PARTITION BY t) AS n FROM d)
SELECT doc_id, k AS keep_id, n AS group_size, doc_id IS NOT DISTINCT FROM k AS kept, h AS text_sha256 FROM g
"""

OP10_SQL = """
WITH RECURSIVE c AS (SELECT coalesce(source, '') AS s, count(*) AS n FROM documents GROUP BY 1),
r AS (SELECT s, (SELECT sum(n) FROM c) / (SELECT sum(sqrt(n)) FROM c) * sqrt(n) / n AS rate FROM c),
u AS (SELECT d.*, r.rate, (CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':1'), 1, 13) AS BIGINT) + 0.5)
      / 4503599627370496.0 AS u FROM documents d JOIN r ON r.s = coalesce(d.source, '')),
walk AS (
  SELECT doc_id, rate, u, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM u
  UNION ALL
  SELECT doc_id, rate, u, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM walk WHERE u > c AND k < 80),
n AS (SELECT doc_id, max(k) AS copies FROM walk GROUP BY doc_id),
x AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, n.copies, unnest(range(0, n.copies)) AS copy
      FROM documents d JOIN n ON d.doc_id = n.doc_id WHERE n.copies > 0)
SELECT doc_id, text, lang, source, n_chars, CAST(copies AS INTEGER) AS copies, CAST(copy AS INTEGER) AS copy,
  CAST('0x' || substr(md5('order17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(copy AS VARCHAR)), 1, 13) AS BIGINT) AS order_key
FROM x
"""

OP11_SQL = """
WITH fold AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
places AS (SELECT item, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, m, array_to_string(w[p:p + m - 1], ' ') AS t FROM places),
starts AS (
  SELECT r, x.m, w, unnest(range(1, len(w) - x.m + 2)) AS p FROM fold, (SELECT DISTINCT m FROM windows) x WHERE len(w) >= x.m),
texts AS (SELECT r, m, p, array_to_string(w[p:p + m - 1], ' ') AS t FROM starts),
hits AS (SELECT x.r, x.m, x.p, y.item FROM texts x JOIN windows y ON x.m = y.m AND x.t = y.t),
covered AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT DISTINCT r, unnest(range(p, p + m)) AS q FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT f.doc_id, CAST(len(f.w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
  sha256(coalesce(i.s, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM fold f LEFT JOIN covered c ON f.r = c.r LEFT JOIN found i ON f.r = i.r
"""

OP12_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
g AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
tf AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY t),
m AS (SELECT r, doc_id, 10 + (90 * CAST(len(w) AS BIGINT) * n_docs) // n_terms AS m FROM d, g WHERE len(w) > 0),
s AS (SELECT item_id, r, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) AS BIGINT) AS score
      FROM tf JOIN m USING (r) JOIN w USING (t) JOIN q USING (t) GROUP BY item_id, r),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op1_topk_search", OP1_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read(spark, sf, "embeddings")
    return top_k(vectors.filter(F.col("vec_id") % 100 == 0), vectors, k=10, scale=1024.0)


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup(read(spark, sf, "documents"), window=50).drop("spans")


@query("op3_line_dedup")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup(read(spark, sf, "documents"), percent=80).select("doc_id", "n_lines", "n_removed_lines", "text")


@query("op4_exact_dedup", OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(read(spark, sf, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_toxicity(read(spark, sf, "documents").select("doc_id", "text"), read(spark, sf, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "offending")


@query("op6_best_fit_packing")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(read(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


@query("op7_secret_scan")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return scan_secrets(read(spark, sf, "documents"))


@query("op8_minhash_near_dedup")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup(read(spark, sf, "documents"), size=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_quality(read(spark, sf, "documents").select("doc_id", "text"), read(spark, sf, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op10_mixing", OP10_SQL)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(read(spark, sf, "documents"))


@query("op11_decontamination", OP11_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate(read(spark, sf, "documents"), read(spark, sf, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), digest, (F.size("spans") > 0).alias("contaminated"))


@query("op12_lexical_search", OP12_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_search(read(spark, sf, "documents"), read(spark, sf, "benchmark"), k=10)


@query("op13_token_alignment")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return align_tokens(read(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
