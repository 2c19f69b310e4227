"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm.common import LOWER, UPPER, table
from lathework.llm.decontaminate import contaminated, overlap
from lathework.llm.hamming import top_k
from lathework.llm.katz import score_katz
from lathework.llm.line_dedup import drop_repeated_lines
from lathework.llm.packing import pack
from lathework.llm.pii import find_pii
from lathework.llm.quality import score_quality, training_rows
from lathework.llm.repeats import drop_repeats
from lathework.llm.simhash import simhash_groups
from lathework.llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (~training_rows("doc_id", 5, 0)).alias("held_out"), "score", "predicted")


def op2_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP2_SQL = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id,
         len(list_filter(list_zip(q.bits, r.bits), lambda z: z[1] <> z[2])) AS distance
  FROM c q, c r WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM pairs
)
SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
"""


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, spans = F.array_join("base_spans", ","), F.array_join("spans", ",")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


def op4_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_katz(table(spark, sf_dir, "documents"), training_rows("doc_id", 7, 2))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM lines
), often AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, o.key IS NOT NULL AND k.doc_id <> o.keeper AS lost FROM keyed k LEFT JOIN often o USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = overlap(docs, table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), listed, contaminated().alias("contaminated"))


OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS g
  FROM (SELECT *, least(len(w), 13) AS size, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM win
), dw AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), hit AS (
  SELECT doc_id, i, win.size, item_id FROM dw JOIN win ON dw.size = win.size AND dw.g = win.g
), n AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hit) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_hamming_topk": op2_hamming_topk,
    "op3_packing": op3_packing,
    "op4_katz_lm": op4_katz_lm,
    "op5_url_filter": op5_url_filter,
    "op6_simhash_neardup": op6_simhash_neardup,
    "op7_decontamination": op7_decontamination,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_pii": op9_pii,
    "op10_line_dedup": op10_line_dedup,
}
ORACLES: dict[str, str] = {"op2_hamming_topk": OP2_SQL, "op7_decontamination": OP7_SQL, "op10_line_dedup": OP10_SQL}
