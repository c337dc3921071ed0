"""The contract queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import bpe, chat_format, chunk_dedup, decontaminate, fill_middle, filter_audit, kd_shards, near_dedup, quality, suffix_dedup, token_count, toxicity, url_filter


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.bpe_round_trip(docs, bpe.default_vocabulary(spark))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    out = url_filter.filter_urls(pages, url_filter.rule_frame(spark, url_filter.RULES))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out = kd_shards.kd_shards(docs, shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.find_contamination(docs, _read(spark, sf_dir, "benchmark"), keep_text=False)
    items = F.sha2(F.concat_ws(",", "items"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def op7_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.chunk_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, _read(spark, sf_dir, "labels"), keep_text=False)


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, token_count.default_model(spark))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = filter_audit.failures(_read(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return filter_audit.audit(failed, _read(spark, sf_dir, "labels"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.fill_in_middle(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    again = fill_middle.restored(F.col("fim"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("fim", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for i, r in enumerate(("user", "assistant"))])
    conversations = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.range(1).select(F.inline(turns)))
    return chat_format.digests(chat_format.format_chat(conversations))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_bpe, op2_near_dedup, op3_url_filter, op4_kd_shards, op5_decontaminate, op6_suffix_dedup, op7_chunk_dedup, op8_quality, op9_toxicity, op10_token_count, op11_filter_audit, op12_fill_in_middle, op13_chat_format)
    return {f.__name__: f for f in found}


OP3_SQL = """
WITH parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
hits AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path)
SELECT page_id, parts.host, parts.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN hits ON parts.host = hits.host AND parts.path = hits.path
"""


OP11_SQL = """
WITH cut AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
flags AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM cut),
known AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
marked AS (SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM flags LEFT JOIN known USING (doc_id)),
letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, CAST(s AS INT) AS step, filter_order[s] AS f, filter_order[1:s - 1] AS before FROM orders, range(1, 6) r(s)),
judged AS (
  SELECT part, filter_order, step, f, good, toxic, length(fails) AS k,
         contains(fails, f) AS here, before <> '' AND regexp_matches(fails, '[' || before || '_]') AS earlier
  FROM marked, steps),
counted AS (
  SELECT part, filter_order, step, f,
         count(*) FILTER (NOT here AND NOT earlier) AS kept, count(*) FILTER (here AND NOT earlier) AS removed,
         count(*) FILTER (here AND earlier) AS redundant, count(*) FILTER (here AND k = 1) AS unique_fails,
         count(*) FILTER (here AND NOT earlier AND good = 1) AS good_lost, count(*) FILTER (here AND NOT earlier AND toxic = 1) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""

OP12_SQL = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
hashed AS (
  SELECT doc_id, t, units, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS c2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM cut),
parts AS (
  SELECT doc_id, t, n, array_to_string(units[1:least(c1, c2)], '') AS p, array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(units[greatest(c1, c2) + 1:], '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

#: The windows' law again: turns on a line of tokens, cut by a grid; lengths with the escaped texts.
OP13_SQL = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
costed AS (
  SELECT *, 8 + len(regexp_extract_all(t, '[\\p{L}\\p{M}]+|\\p{N}|[^\\p{L}\\p{M}\\p{N}\\x20\\x09-\\x0D]')) AS cost,
         20 + length(role) + len(regexp_extract_all(role, '[<\\[]\\\\*/?(?:s>|INST\\])')) + length(t) + len(regexp_extract_all(t, '[<\\[]\\\\*/?(?:s>|INST\\])')) AS chars
  FROM said),
ranked AS (
  SELECT *, row_number() OVER line AS rank, sum(cost) OVER line - cost AS upto
  FROM costed WINDOW line AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, t ROWS UNBOUNDED PRECEDING)),
sized AS (
  SELECT *, rank = 1 AND role = 'system' AS is_head,
         coalesce(max(cost) FILTER (rank = 1 AND role = 'system') OVER whole, 0) AS head,
         coalesce(max(cost) FILTER (NOT (rank = 1 AND role = 'system')) OVER whole, 0) AS longest,
         max(upto) OVER whole AS before_last
  FROM ranked WINDOW whole AS (PARTITION BY conv_id)),
gridded AS (SELECT *, greatest(1024 - 128 - head - longest, 256) AS grid FROM sized),
spans AS (
  SELECT *, CASE WHEN is_head THEN 0 ELSE (upto - head) // grid END AS f,
         CASE WHEN is_head THEN greatest(before_last - head, 0) // grid ELSE (upto - head + 128) // grid END AS l
  FROM gridded),
shown AS (SELECT conv_id, f, chars, unnest(range(CAST(f AS BIGINT), CAST(l AS BIGINT) + 1)) AS w FROM spans),
sizes AS (
  SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM (SELECT conv_id, w, sum(chars) AS chars FROM shown GROUP BY conv_id, w HAVING bool_or(f = w)) GROUP BY conv_id),
whole AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY rank)) AS turns_sha256,
         coalesce(string_agg(t, '' ORDER BY rank) FILTER (role = 'assistant'), '') AS loss
  FROM ranked GROUP BY conv_id)
SELECT whole.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM whole JOIN sizes ON whole.conv_id IS NOT DISTINCT FROM sizes.conv_id
"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the operator in sensible time; tests/llm compares the others with brute force."""
    return {"op3_url_filter": OP3_SQL, "op11_filter_audit": OP11_SQL, "op12_fill_in_middle": OP12_SQL, "op13_chat_format": OP13_SQL}
