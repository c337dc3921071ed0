"""Conforming sources to one schema; identity and merge of records; pruned scans and decoded pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (
    blank_to_null,
    is_true,
    namespaced_id,
    ordered_case,
    recovered_key,
    regex_group,
    rounded_to_long,
    sentinel_to_null,
)
from ..operators.conform import Source, Target, conform_union, retained
from ..operators.records import count_duplicates
from ..sources.pages import bounds, scan_windows, windows
from .common import KEYED_SQL, MERGED_SQL, keyed_lines, merged_lines, table

PARTY = [Target("name", clean=True), Target("nation", "int"), Target("balance", "double"), Target("segment", clean=True, default=None), Target("is_debtor", "boolean"), Target("region_code")]
SOURCES = [
    Source("C", "customers", "c_custkey", {"name": "c_name", "nation": "c_nationkey", "balance": "c_acctbal", "segment": "nullif(c_mktsegment, 'MACHINERY')", "is_debtor": "coalesce(c_acctbal < 0, false)"}, key_fields=("c_nationkey",), constants={"value_basis": "ledger"}),
    Source("S", "suppliers", "s_suppkey", {"name": "s_name", "nation": "s_nationkey", "balance": "s_acctbal", "is_debtor": "s_acctbal < 0"}, constants={"value_basis": "ledger"}),
]


def conform_union_(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {"C": table(spark, sf_dir, "customer"), "S": table(spark, sf_dir, "supplier")}
    out = conform_union(frames, SOURCES, PARTY, "2026-01-01 00:00:00")
    return out.select("uid", "record_key", "source_key", "source_name", *[t.name for t in PARTY], "value_basis", F.col("ingested_at").cast("date").alias("ingested_on"))


CONFORM_UNION = """
SELECT 'C-' || c_custkey AS uid, 'C-' || c_custkey || '|' || c_nationkey AS record_key, 'C' AS source_key, 'customers' AS source_name,
       nullif(trim(c_name), '') AS name, c_nationkey AS nation, c_acctbal AS balance, nullif(trim(nullif(c_mktsegment, 'MACHINERY')), '') AS segment,
       coalesce(c_acctbal < 0, false) AS is_debtor, CAST(NULL AS VARCHAR) AS region_code, 'ledger' AS value_basis, DATE '2026-01-01' AS ingested_on
FROM customer
UNION ALL
SELECT 'S-' || s_suppkey, 'S-' || s_suppkey, 'S', 'suppliers', nullif(trim(s_name), ''), s_nationkey, s_acctbal, NULL, s_acctbal < 0, NULL, 'ledger', DATE '2026-01-01'
FROM supplier
"""


def blank_to_null_(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    spaced = F.when(F.col("o_orderkey") % 5 == 0, F.lit("   ")).otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")))
    status = F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderstatus"))
    return o.select(
        "o_orderkey",
        blank_to_null(spaced).alias("priority"),
        sentinel_to_null(F.col("o_orderpriority"), "4-NOT SPECIFIED").alias("priority_known"),
        F.col("o_orderpriority").alias("priority_raw"),
        is_true(status == "F").alias("is_final"),
        rounded_to_long(F.col("o_totalprice") / 100).alias("hundreds"),
    )


BLANK_TO_NULL = """
SELECT o_orderkey, nullif(trim(CASE WHEN o_orderkey % 5 = 0 THEN '   ' ELSE ' ' || o_orderpriority || ' ' END), '') AS priority,
       nullif(trim(o_orderpriority), '4-NOT SPECIFIED') AS priority_known, o_orderpriority AS priority_raw,
       coalesce(CASE WHEN o_custkey % 3 <> 0 THEN o_orderstatus END = 'F', false) AS is_final,
       CAST(round_even(o_totalprice / 100, 0) AS BIGINT) AS hundreds
FROM orders
"""


def regex_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("raw"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("raw"))
    both = c.unionByName(o.distinct())
    return both.select("raw", regex_group(F.col("raw"), "#0*([0-9]+)$").alias("number"), regex_group(F.col("raw"), "^([0-9])-").alias("code"), regex_group(F.col("raw"), "^[0-9]-(.+)$").alias("description"), regex_group(F.col("raw"), "([0-9]{5})$").alias("zip5"))


REGEX_SPLIT = """
SELECT raw, nullif(regexp_extract(raw, '#0*([0-9]+)$', 1), '') AS number, nullif(regexp_extract(raw, '^([0-9])-', 1), '') AS code,
       nullif(regexp_extract(raw, '^[0-9]-(.+)$', 1), '') AS description, nullif(regexp_extract(raw, '([0-9]{5})$', 1), '') AS zip5
FROM (SELECT trim(c_name) AS raw FROM customer UNION ALL SELECT DISTINCT trim(o_orderpriority) FROM orders)
"""


def recovered_key_(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    published = F.when(F.col("c_custkey") % 4 != 0, F.lpad(F.col("c_nationkey").cast("string"), 3, "0"))
    ident = F.when(F.col("c_custkey") % 10 != 0, namespaced_id(F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.col("c_custkey")))
    key, recovered = recovered_key(published, ident, "^([0-9]{3})-")
    return c.select("c_custkey", key.alias("nation_code"), recovered.alias("is_recovered")).where(F.col("nation_code").isin(*[f"{i:03d}" for i in range(20)]))


RECOVERED_KEY = """
SELECT * FROM (
  SELECT c_custkey, coalesce(CASE WHEN c_custkey % 4 <> 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END,
                             nullif(regexp_extract(CASE WHEN c_custkey % 10 <> 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || '-' || c_custkey END, '^([0-9]{3})-', 1), '')) AS nation_code,
         c_custkey % 4 = 0 AS is_recovered
  FROM customer) WHERE nation_code < '020'
"""


def record_key_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_lines(spark, sf_dir).select("uid", "record_key", "record_signature", "l_linenumber")


def record_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_lines(spark, sf_dir)


def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key is shared, counted by source: which sources duplicates are confined to."""
    return count_duplicates(keyed_lines(spark, sf_dir), "record_key", "l_returnflag")


DUPLICATE_IDS = f"""
WITH {KEYED_SQL}, again AS (SELECT record_key FROM keyed WHERE record_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT l_returnflag, duplicate_id, count(*) AS n_rows, count(DISTINCT record_key) AS n_keys
FROM (SELECT *, record_key IS NOT NULL AND record_key IN (SELECT record_key FROM again) AS duplicate_id FROM keyed) GROUP BY ALL
"""


def projected_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension projection over a pruned read: the excluded columns never reach the scan."""
    c = table(spark, sf_dir, "customer")
    c = c.select(*retained(c.columns, ["C_ACCTBAL", "c_name"])).where("c_mktsegment <> 'BUILDING'")
    return c.select(namespaced_id(F.lit("C"), F.col("c_custkey")).alias("uid"), F.col("c_nationkey").cast("smallint").cast("int").alias("nation"), ordered_case([(F.col("c_mktsegment") == "MACHINERY", "industry"), (F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE"), "home")]).alias("kind"), F.col("c_mktsegment").alias("segment"))


PROJECTED_SCAN = """
SELECT 'C-' || c_custkey AS uid, c_nationkey AS nation, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'industry' WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'home' END AS kind, c_mktsegment AS segment
FROM customer WHERE c_mktsegment <> 'BUILDING'
"""


def page_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON attributes with a declared schema, and the rows of each key window with its bounds."""
    e = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "struct<k:string,absent:string>").alias("p"))
    size = 1000
    ends = bounds(e, "event_id").first()  # one row
    scanned = scan_windows(e, "event_id", windows(spark, ends["low"] or 0, ends["high"] or 0, size), "p.k is not null")
    k = F.col("p.k").try_cast("int")
    return scanned.groupBy(F.col("start").alias("window_start")).agg(F.count("*").alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high"), F.sum(k).alias("sum_k"), F.count("p.absent").alias("n_absent"))


PAGE_DECODE = """
WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent') AS absent FROM events),
     b AS (SELECT min(event_id) AS low FROM e)
SELECT low + ((event_id - low) // 1000) * 1000 AS window_start, count(*) AS n, min(event_id) AS low, max(event_id) AS high, CAST(sum(TRY_CAST(k AS INTEGER)) AS BIGINT) AS sum_k, count(absent) AS n_absent
FROM e, b WHERE k IS NOT NULL GROUP BY 1
"""

QUERIES = {
    "conform_union": conform_union_,
    "blank_to_null": blank_to_null_,
    "regex_split": regex_split,
    "recovered_key": recovered_key_,
    "record_key_signature": record_key_signature,
    "record_merge": record_merge,
    "duplicate_ids": duplicate_ids,
    "projected_scan": projected_scan,
    "page_decode": page_decode,
}
SQL = {
    "conform_union": CONFORM_UNION,
    "blank_to_null": BLANK_TO_NULL,
    "regex_split": REGEX_SPLIT,
    "recovered_key": RECOVERED_KEY,
    "record_key_signature": f"WITH {KEYED_SQL} SELECT uid, record_key, record_signature, l_linenumber FROM keyed",
    "record_merge": f"WITH {MERGED_SQL} SELECT * FROM merged",
    "duplicate_ids": DUPLICATE_IDS,
    "projected_scan": PROJECTED_SCAN,
    "page_decode": PAGE_DECODE,
}
