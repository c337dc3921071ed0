"""Line items rolled up to orders against the orders table: statuses, classes, drift and vintages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contracts as C
from ..operators.reconcile import Comparable, disagreement_text, reconcile, with_vintages
from .common import money, table

FIELDS = [
    Comparable("lines", "sum"),
    Comparable("status", text=True),
    Comparable("priority", text=True),
    Comparable("price", "sum", drift=True),
    Comparable("year", incomparable=True),
]


def ours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items at their own grain, as one side of the reconciliation."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("uid"),
        F.lit(1).cast("long").alias("lines"),
        F.when(F.col("l_suppkey") % 13 != 0, F.concat(F.lit(" "), F.lower("l_linestatus"))).alias("status"),
        F.when(F.col("l_returnflag") == "N", F.lit("5-LOW")).alias("priority"),
        money("l_extendedprice").alias("price"),
        F.year("l_shipdate").alias("year"),
    )


def theirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer key: orders of most customers, with fewer facts for some."""
    o = table(spark, sf_dir, "orders").where("o_custkey % 10 <> 3")
    return o.select(
        F.col("o_orderkey").alias("uid"),
        F.when(F.col("o_orderkey") % 17 != 0, F.lit(4)).cast("long").alias("lines"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority"),
        money("o_totalprice").alias("price"),
        F.year("o_orderdate").alias("year"),
    )


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reconcile(ours(spark, sf_dir), theirs(spark, sf_dir), "uid", FIELDS)
    out = out.withColumns({c: F.col(c).cast("double") for c in ("ours_price", "theirs_price")})
    return out.withColumn("source", F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R"), F.lit("X")), (F.col("uid") % 4 + 1).cast("int")))


def _status(f: str, text: bool = False) -> str:
    a, b = (f"upper(trim(ours_{f}))", f"upper(trim(theirs_{f}))") if text else (f"ours_{f}", f"theirs_{f}")
    return f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN 'both_null' WHEN {a} IS NULL THEN 'ours_absent' WHEN {b} IS NULL THEN 'theirs_absent' WHEN {a} = {b} THEN 'agree' ELSE 'disagree' END"


RECONCILED_SQL = f"""
ours_side AS (
  SELECT l_orderkey AS uid, count(*) AS ours_records, count(*) AS ours_lines,
         min(CASE WHEN l_suppkey % 13 <> 0 THEN ' ' || lower(l_linestatus) END) AS ours_status, count(DISTINCT CASE WHEN l_suppkey % 13 <> 0 THEN l_linestatus END) AS ours_status_variants,
         min(CASE WHEN l_returnflag = 'N' THEN '5-LOW' END) AS ours_priority, count(DISTINCT CASE WHEN l_returnflag = 'N' THEN 1 END) AS ours_priority_variants,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS ours_price,
         CAST(min(year(l_shipdate)) AS INTEGER) AS ours_year, count(DISTINCT year(l_shipdate)) AS ours_year_variants
  FROM lineitem GROUP BY 1),
theirs_side AS (
  SELECT o_orderkey AS uid, count(*) AS theirs_records, CAST(sum(CASE WHEN o_orderkey % 17 <> 0 THEN 4 END) AS BIGINT) AS theirs_lines,
         min(nullif(o_orderstatus, 'P')) AS theirs_status, count(DISTINCT nullif(o_orderstatus, 'P')) AS theirs_status_variants,
         min(nullif(o_orderpriority, '4-NOT SPECIFIED')) AS theirs_priority, count(DISTINCT nullif(o_orderpriority, '4-NOT SPECIFIED')) AS theirs_priority_variants,
         CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS theirs_price,
         CAST(min(year(o_orderdate)) AS INTEGER) AS theirs_year, count(DISTINCT year(o_orderdate)) AS theirs_year_variants
  FROM orders WHERE o_custkey % 10 <> 3 GROUP BY 1),
stated AS (
  SELECT *, ours_records IS NULL AS ours_absent, theirs_records IS NULL AS theirs_absent,
         {_status("lines")} AS lines_status, {_status("status", True)} AS status_status, {_status("priority", True)} AS priority_status,
         {_status("price")} AS price_status, {_status("year")} AS year_status
  FROM ours_side FULL JOIN theirs_side USING (uid)),
recon AS (
  SELECT *, CASE WHEN ours_absent THEN 'theirs_only' WHEN theirs_absent THEN 'ours_only' WHEN 'disagree' IN (lines_status, status_status, priority_status) THEN 'both_differ' ELSE 'both_match' END AS reconciliation_class,
         price_status = 'disagree' AS value_drift, CASE uid % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' ELSE 'X' END AS source
  FROM stated)"""


def field_status_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciled(spark, sf_dir).select("uid", *[f"{f.name}_status" for f in FIELDS], disagreement_text([f for f in FIELDS if f.name != "price"]).alias("disagreement"))


_TEXT = ", ".join(f"CASE WHEN {f}_status = 'disagree' THEN '{f}: ' || ours_{f} || ' ≠ ' || theirs_{f} END" for f in ("lines", "status", "priority", "year"))


def reconcile_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciled(spark, sf_dir).groupBy("reconciliation_class").agg(F.count("*").alias("n"), F.sum("ours_records").alias("ours_records"), F.sum("theirs_records").alias("theirs_records"))


def value_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift is told apart from disagreement: the class doesn't depend on it."""
    return reconciled(spark, sf_dir).groupBy("source", "reconciliation_class", "value_drift").agg(F.count("*").alias("n"))


def vintage_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each side's last publication by source, and the days between them."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    ours_last = li.groupBy(F.col("l_linestatus").alias("status")).agg(F.max(F.col("l_shipdate").cast("date")).alias("published"))
    theirs_last = o.groupBy(F.col("o_orderstatus").alias("status")).agg(F.max(F.col("o_orderdate").cast("date")).alias("published"))
    counts = o.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    return with_vintages(counts, "status", ours_last, theirs_last)


VINTAGE_GAP = """
SELECT o.status, o.n, l.published AS our_published, o.published AS their_published, CAST(date_diff('day', o.published, l.published) AS INTEGER) AS vintage_gap_days
FROM (SELECT o_orderstatus AS status, count(*) AS n, max(CAST(o_orderdate AS DATE)) AS published FROM orders GROUP BY 1) o
LEFT JOIN (SELECT l_linestatus AS status, max(CAST(l_shipdate AS DATE)) AS published FROM lineitem GROUP BY 1) l USING (status)
"""


def balance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full outer join neither makes nor loses keys, classes fit statuses, keys are whole."""
    r = reconciled(spark, sf_dir)
    sourced = lambda d: d.withColumn("source", F.col("uid") % 4)
    classes = ["both_match", "both_differ", "ours_only", "theirs_only"]
    differs = F.lit("disagree").isin(*[F.col(f"{f}_status") for f in ("lines", "status", "priority")])
    return C.violation_counts(
        {
            "keys_balance": C.balance(sourced(ours(spark, sf_dir)), sourced(theirs(spark, sf_dir)), sourced(r), "uid", "source"),
            "class_fits_statuses": C.expect_true(r.where("not ours_absent and not theirs_absent"), differs == (F.col("reconciliation_class") == "both_differ")),
            "class_vocabulary": C.expect_values(r, "reconciliation_class", classes),
            "key_present": C.expect_not_null(r, "uid"),
            "key_unique": C.expect_unique(r, "uid"),
            "drift_is_measured": C.expect_not_null(r, "value_drift"),
        }
    )


BALANCE_CHECK = f"""
WITH {RECONCILED_SQL},
got AS (SELECT uid % 4 AS s, count(*) FILTER (NOT ours_absent) AS a, count(*) FILTER (NOT theirs_absent) AS b FROM recon GROUP BY 1),
ours_keys AS (SELECT l_orderkey % 4 AS s, count(DISTINCT l_orderkey) AS a FROM lineitem GROUP BY 1),
their_keys AS (SELECT o_orderkey % 4 AS s, count(DISTINCT o_orderkey) AS b FROM orders WHERE o_custkey % 10 <> 3 GROUP BY 1)
SELECT 'keys_balance' AS contract, 'error' AS severity, count(*) AS violations FROM got FULL JOIN ours_keys USING (s) FULL JOIN their_keys USING (s)
 WHERE coalesce(got.a, 0) <> coalesce(ours_keys.a, 0) OR coalesce(got.b, 0) <> coalesce(their_keys.b, 0)
UNION ALL SELECT 'class_fits_statuses', 'error', count(*) FROM recon WHERE NOT ours_absent AND NOT theirs_absent AND ('disagree' IN (lines_status, status_status, priority_status)) <> (reconciliation_class = 'both_differ')
UNION ALL SELECT 'class_vocabulary', 'error', count(DISTINCT reconciliation_class) FROM recon WHERE reconciliation_class NOT IN ('both_match', 'both_differ', 'ours_only', 'theirs_only')
UNION ALL SELECT 'key_present', 'error', count(*) FROM recon WHERE uid IS NULL
UNION ALL SELECT 'key_unique', 'error', count(*) FROM (SELECT uid FROM recon GROUP BY uid HAVING count(*) > 1)
UNION ALL SELECT 'drift_is_measured', 'error', count(*) FROM recon WHERE value_drift IS NULL
"""

QUERIES = {
    "field_status": field_status_,
    "reconcile_full": reconciled,
    "reconcile_class_counts": reconcile_class_counts,
    "value_drift": value_drift,
    "vintage_gap": vintage_gap,
    "balance_check": balance_check,
}
SQL = {
    "field_status": f"WITH {RECONCILED_SQL} SELECT uid, lines_status, status_status, priority_status, price_status, year_status, nullif(concat_ws('; ', {_TEXT}), '') AS disagreement FROM recon",
    "reconcile_full": f"WITH {RECONCILED_SQL} SELECT * FROM recon",
    "reconcile_class_counts": f"WITH {RECONCILED_SQL} SELECT reconciliation_class, count(*) AS n, CAST(sum(ours_records) AS BIGINT) AS ours_records, CAST(sum(theirs_records) AS BIGINT) AS theirs_records FROM recon GROUP BY 1",
    "value_drift": f"WITH {RECONCILED_SQL} SELECT source, reconciliation_class, value_drift, count(*) AS n FROM recon GROUP BY ALL",
    "vintage_gap": VINTAGE_GAP,
    "balance_check": BALANCE_CHECK,
}
