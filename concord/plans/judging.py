"""Rejection rules, flags, the split, quarantine and the contracts around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ratio, tri_state
from ..operators import contracts as C
from ..operators.records import duplicated_ids
from ..operators.rules import Rule, flags, judge, quarantine_summary, registry_frame, split
from ..sources.sinks import load_figures
from .common import JUDGED_SQL, KEYED_SQL, MERGED_SQL, RECORD_RULES, judged_lines, keyed_lines, merged_lines, table

DOCUMENT_RULES = [
    Rule("no_text", "the text is missing", "text is null or length(text) = 0"),
    Rule("too_short", "under 200 characters", "n_chars < 200"),
    Rule("foreign", "a language out of scope", "lang not in ('en', 'de', 'fr')"),
    Rule("bad_source", "a source known for junk", "source in ('src3', 'src7')"),
]


def rule_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), DOCUMENT_RULES).select("doc_id", "rejection_reason")


_REASON = "CASE WHEN text IS NULL OR length(text) = 0 THEN 'no_text' WHEN n_chars < 200 THEN 'too_short' WHEN lang NOT IN ('en', 'de', 'fr') THEN 'foreign' WHEN source IN ('src3', 'src7') THEN 'bad_source' END"


def flags_tristate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ratio flag whose denominator may be missing, and a range flag on text."""
    o = table(spark, sf_dir, "orders")
    reported = F.when(F.col("o_custkey") % 7 != 0, (F.col("o_custkey") % 9).cast("double"))
    o = o.withColumn("ratio", ratio(F.col("o_totalprice") / 100000, reported)).withColumn("code", F.when(F.col("o_orderkey") % 6 != 0, F.substring("o_orderpriority", 1, 1)))
    rules = [Rule("off", "ratio off by more than a half", "abs(ratio - 1) > 0.5"), Rule("implausible", "code out of range", "code is not null and not code between '2' and '4'")]
    o = o.select("*", *flags(rules))
    return o.select("o_orderkey", "off", "implausible", tri_state(F.col("off")).alias("off_outcome"))


FLAGS_TRISTATE = """
WITH o AS (SELECT o_orderkey, o_totalprice / 100000 / nullif(CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_custkey % 9 AS DOUBLE) END, 0) AS ratio,
                  CASE WHEN o_orderkey % 6 <> 0 THEN substr(o_orderpriority, 1, 1) END AS code FROM orders),
     f AS (SELECT *, abs(ratio - 1) > 0.5 AS off, code IS NOT NULL AND NOT (code BETWEEN '2' AND '4') AS implausible FROM o)
SELECT o_orderkey, off, implausible, CASE WHEN off THEN 'flagged' WHEN off IS NULL THEN 'not_measurable' ELSE 'clear' END AS off_outcome FROM f
"""


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), DOCUMENT_RULES)
    published, quarantined = split(judged)
    count = lambda d, name: d.groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars")).withColumn("side", F.lit(name))
    return count(published, "published").unionByName(count(quarantined, "quarantined"))


SPLIT_COUNTS = f"""
SELECT source, CASE WHEN reason IS NULL THEN 'published' ELSE 'quarantined' END AS side, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars
FROM (SELECT *, {_REASON} AS reason FROM documents) GROUP BY ALL
"""


def quarantine_summary_(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantined = split(judged_lines(spark, sf_dir))
    return quarantine_summary(quarantined, RECORD_RULES[:2], "source", F.col("source_record_count")).orderBy("source", "rejection_reason")


QUARANTINE_SUMMARY = f"""
WITH {JUDGED_SQL}
SELECT source, rejection_reason, count(*) AS rejected_rows, CAST(sum(source_record_count) AS BIGINT) AS rejected_source_rows,
       CASE rejection_reason WHEN 'missing_id' THEN 'the record has no id' WHEN 'quantity_too_large' THEN 'more than any order can hold' ELSE 'unregistered rejection reason' END AS description
FROM judged WHERE rejection_reason IS NOT NULL GROUP BY ALL
"""


def canary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows staged, and rows behind published and rejected records, by source (and how many don't balance)."""
    staged = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "source")
    published, rejected = split(judged_lines(spark, sf_dir))
    broken = C.row_conservation(staged, published, rejected, "source").agg(F.count("*").alias("violations"))
    sums = [d.groupBy("source").agg(F.sum("source_record_count").cast("long").alias(n)) for d, n in ((published, "published"), (rejected, "rejected"))]
    return staged.groupBy("source").agg(F.count("*").alias("staged")).join(sums[0], "source", "left").join(sums[1], "source", "left").crossJoin(F.broadcast(broken))  # one row


CANARY_ROWS = f"""
WITH {JUDGED_SQL}
SELECT l_returnflag AS source, count(*) AS staged,
       (SELECT CAST(sum(source_record_count) AS BIGINT) FROM judged WHERE source = l_returnflag AND rejection_reason IS NULL) AS published,
       (SELECT CAST(sum(source_record_count) AS BIGINT) FROM judged WHERE source = l_returnflag AND rejection_reason IS NOT NULL) AS rejected,
       (SELECT count(*) FROM (SELECT l_returnflag AS f, count(*) AS n FROM lineitem GROUP BY 1) x WHERE n <> coalesce((SELECT sum(source_record_count) FROM judged WHERE source = f), 0)) AS violations
FROM lineitem GROUP BY l_returnflag
"""


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each contract; some are meant to be broken by these tables."""
    lines, judged, orders = keyed_lines(spark, sf_dir), judged_lines(spark, sf_dir), table(spark, sf_dir, "orders")
    published, rejected = split(judged)
    staged = lines.withColumnRenamed("l_returnflag", "source")
    return C.violation_counts(
        {
            "key_not_null": C.expect_not_null(lines, "record_key"),
            "order_unique": C.expect_unique(orders, "o_orderkey"),
            "key_unique": C.expect_unique(lines, "record_key"),
            "status_values": C.expect_values(orders, "o_orderstatus", ["O", "F"]),
            "reasons_known": C.expect_known(judged, "rejection_reason", registry_frame(spark, RECORD_RULES[:2]), "rejection_reason"),
            "published_have_ids": C.expect_true(published, F.col("record_key").isNotNull()),
            "rejected_have_ids": C.expect_true(rejected, F.col("record_key").isNotNull()),
            "reject_rate": C.reject_rate(staged, rejected, "source", 0.05),
            "total_count": C.expect_true(judged.agg(F.sum("source_record_count").alias("n")).crossJoin(F.broadcast(lines.agg(F.count("*").alias("m")))), F.col("n") == F.col("m")),
            "price_present": C.expect_true(orders, F.col("o_totalprice") > 1000),
        },
        {"price_present": "warn"},
    )


CONTRACT_VIOLATIONS = f"""
WITH {JUDGED_SQL}
SELECT 'key_not_null' AS contract, 'error' AS severity, count(*) AS violations FROM keyed WHERE record_key IS NULL
UNION ALL SELECT 'order_unique', 'error', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'key_unique', 'error', count(*) FROM (SELECT 1 FROM keyed WHERE record_key IS NOT NULL GROUP BY record_key HAVING count(*) > 1)
UNION ALL SELECT 'status_values', 'error', count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
UNION ALL SELECT 'reasons_known', 'error', count(DISTINCT rejection_reason) FROM judged WHERE rejection_reason NOT IN ('missing_id', 'quantity_too_large')
UNION ALL SELECT 'published_have_ids', 'error', count(*) FROM judged WHERE rejection_reason IS NULL AND record_key IS NULL
UNION ALL SELECT 'rejected_have_ids', 'error', count(*) FROM judged WHERE rejection_reason IS NOT NULL AND record_key IS NULL
UNION ALL SELECT 'reject_rate', 'error', count(*) FROM (SELECT source, sum(source_record_count) FILTER (rejection_reason IS NOT NULL) AS r, sum(source_record_count) AS n FROM judged GROUP BY source) WHERE r / n >= 0.05
UNION ALL SELECT 'total_count', 'error', CASE WHEN (SELECT sum(source_record_count) FROM judged) = count(*) THEN 0 ELSE 1 END FROM keyed
UNION ALL SELECT 'price_present', 'warn', count(*) FROM orders WHERE NOT coalesce(o_totalprice > 1000, false)
"""


def load_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures that a load is judged by, for a sound key and for one that isn't."""
    orders, lines = table(spark, sf_dir, "orders"), keyed_lines(spark, sf_dir)
    parts = [load_figures(d, k).select(F.lit(n).alias("load"), "rows", "distinct_keys", "null_keys") for n, d, k in (("orders", orders, "o_orderkey"), ("lines", lines, "record_key"))]
    return parts[0].unionByName(parts[1])


LOAD_CONTRACT = f"""
WITH {KEYED_SQL}
SELECT 'orders' AS load, count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_keys, count(*) FILTER (o_orderkey IS NULL) AS null_keys FROM orders
UNION ALL SELECT 'lines', count(*), count(DISTINCT record_key), count(*) FILTER (record_key IS NULL) FROM keyed
"""


def merge_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge and duplicate groups side by side: the merged rows of a key are its duplicates."""
    merged = merged_lines(spark, sf_dir).where("record_key is not null and source_record_count > 1")
    again = duplicated_ids(keyed_lines(spark, sf_dir), "record_key")
    both = merged.join(again, "record_key", "full_outer")
    return both.groupBy("source").agg(F.count("*").alias("n"), F.sum("n").cast("long").alias("n_rows"), F.count_if(F.col("n") != F.col("source_record_count")).alias("n_off"))


MERGE_PROVENANCE = f"WITH {MERGED_SQL} SELECT source, count(*) AS n, CAST(sum(m) AS BIGINT) AS n_rows, count(*) FILTER (m <> source_record_count) AS n_off FROM merged FULL JOIN (SELECT record_key, count(*) AS m FROM keyed WHERE record_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1) USING (record_key) WHERE record_key IS NOT NULL AND (m IS NOT NULL OR source_record_count > 1) GROUP BY source"

QUERIES = {
    "rule_case": rule_case,
    "flags_tristate": flags_tristate,
    "split_counts": split_counts,
    "quarantine_summary": quarantine_summary_,
    "canary_rows": canary_rows,
    "contract_violations": contract_violations,
    "load_contract": load_contract,
    "merge_provenance": merge_provenance,
}
SQL = {
    "rule_case": f"SELECT doc_id, {_REASON} AS rejection_reason FROM documents",
    "flags_tristate": FLAGS_TRISTATE,
    "split_counts": SPLIT_COUNTS,
    "quarantine_summary": QUARANTINE_SUMMARY,
    "canary_rows": CANARY_ROWS,
    "contract_violations": CONTRACT_VIOLATIONS,
    "load_contract": LOAD_CONTRACT,
    "merge_provenance": MERGE_PROVENANCE,
}
