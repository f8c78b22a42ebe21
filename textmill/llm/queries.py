"""The queries op1 to op10, each over its whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import chat, contamination, langid, lm, packing, quality, simhash, suffixdedup, tiff, tokencount
from textmill.llm.util import documents, stored


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text_hash")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.edited_counts(stored(tokencount.trees(documents(spark, sf_dir)), "trees"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.digests(tiff.read_pages(tiff.to_media(documents(spark, sf_dir))))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.without_repeats(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(documents(spark, sf_dir))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_corpus(documents(spark, sf_dir))


def queries() -> dict:
    return {f.__name__: f for f in (op1_decontamination, op2_token_counts, op3_quality, op4_language, op5_packing, op6_tiff, op7_chat, op8_suffix_dedup, op9_simhash, op10_lm_scores)}


_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

SQL = {
    "op1_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, n, list_slice(w, s + 1, s + n) AS win
        FROM (SELECT item, w, least(8, len(w)) AS n, unnest(range(0, len(w) - least(8, len(w)) + 1)) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT rid, s, n, list_slice(w, s + 1, s + n) AS win
       FROM (SELECT rid, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT rid, s, dw.n AS n, item FROM dw JOIN win ON dw.n = win.n AND dw.win = win.win),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hits) GROUP BY rid),
its AS (SELECT rid, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(len(items), 0) >= 2 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)""",
    "op7_chat": """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, count(*) AS n, list(role || chr(31) || text ORDER BY turn, role, text) AS k,
             string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
      FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT list_slice(k, 1, i) AS k FROM (SELECT k, unnest(range(1, n)) AS i FROM c)),
u AS (SELECT k, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY k)
SELECT u.conv_id, c.n AS n_turns, u.n_copies, c.rendered FROM u JOIN c USING (conv_id)
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = u.k)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
