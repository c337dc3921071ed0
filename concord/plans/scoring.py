"""The scorecard over merged line items and their reconciliation, long and wide, and headline figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import tri_state
from ..functions.geometry import repair
from ..operators import scorecard as S
from ..operators.records import count_duplicates
from ..operators.rules import Rule, registry_frame, split
from ..sources.sinks import materialise
from .common import JUDGED_SQL, judged_lines, table
from .mapping import SOURCE_SQL, counted_pairs, odd_shapes, outcome, pairs_sql, source
from .reconciling import RECONCILED_SQL, reconciled, theirs

CHECKS = [
    Rule("unit_price_off", "price for each unit against the usual one", ""),
    Rule("discount_high", "discount above the usual", ""),
    Rule("duplicate_uid", "ids that several records have", ""),
    Rule("geometry_valid", "shapes that are valid as stored", ""),
    Rule("geometry_overlap", "pairs of shapes that overlap", ""),
    Rule("discount_coverage", "records whose discount can be judged", ""),
    Rule("status_coverage", "records with a mapped status", ""),
    Rule("attribute_completeness", "any of status and discount known", ""),
    Rule("merge_provenance", "records made of several rows", ""),
    Rule("stacked_components", "records flagged as final", ""),
    Rule("geometry_repaired", "shapes that were repaired", ""),
    Rule("rejection", "rejected records by reason", ""),
    Rule("reconciliation", "records against the answer key", ""),
    Rule("value_drift", "records whose value has moved", ""),
    Rule("field_coverage", "values that one side lacks", ""),
    Rule("key_duplicate_groups", "ids with several rows in the answer key", ""),
    Rule("key_unidentified", "answer-key rows without an id", ""),
    Rule("key_vintage", "last order date in the answer key", ""),
    Rule("source_vintage", "last ship date of the source itself", ""),
]
FIELD_NAMES = ["lines", "status", "priority", "year"]


#: What the blocks read of the two layers; aggregates that make other columns are not computed.
JUDGED_COLUMNS = ["source", "uid", "unit_price_off", "discount_high", "discount", "status", "is_final", "source_record_count", "rejection_reason"]
RECON_COLUMNS = ["source", "reconciliation_class", "value_drift", *[f"{f}_status" for f in FIELD_NAMES]]


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Judged records and their reconciliation, kept as tables: several blocks read them. They go with the session."""
    judged, recon = judged_lines(spark, sf_dir).select(*JUDGED_COLUMNS), reconciled(spark, sf_dir).select(*RECON_COLUMNS)
    return materialise(judged, "judged_lines"), materialise(recon, "reconciled_orders")


def scorecard_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(spark, sf_dir, *_layers(spark, sf_dir)).orderBy("source", "check_name", "outcome")


def _long(spark: SparkSession, sf_dir: str, judged: DataFrame, recon: DataFrame) -> DataFrame:
    published, rejected = split(judged)
    records = S.record_checks(
        published,
        "source",
        {
            "unit_price_off": tri_state(F.col("unit_price_off")),
            "discount_high": tri_state(F.col("discount_high")),
            "discount_coverage": F.when(F.col("discount") > 0, "measurable").otherwise("no_roll_figure"),
            "status_coverage": F.coalesce(F.when(F.col("status") == "F", "derived"), F.lit("unmapped")),
            "attribute_completeness": F.when(F.coalesce(F.nullif(F.col("status"), F.lit("O")), F.col("discount").cast("string")).isNotNull(), "complete").otherwise("attribute_sparse"),
            "merge_provenance": F.when(F.col("source_record_count") > 1, "merged").otherwise("single"),
            "stacked_components": F.when(F.col("is_final"), "stacked").otherwise("not_stacked"),
        },
    )
    # Shapes of a source that are equal are repaired once.
    alike = odd_shapes(spark, sf_dir).groupBy(source().alias("source"), "geom").agg(F.count("*").alias("n_shapes"))
    stored = repair(alike, valid="valid")
    shapes = S.record_checks(stored, "source", {"geometry_valid": F.when(F.col("valid"), "valid").when(~F.col("valid"), "invalid"), "geometry_repaired": F.when(F.col("geometry_repaired"), "repaired")}, n="n_shapes")
    # The date that each source was last published, beside the number of its records: aggregated before the join.
    last = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("source")).agg(F.max(F.col("l_shipdate").cast("date")).cast("string").alias("outcome"))
    # Merged records that are published have a key, each its own.
    counted = published.groupBy("source").agg(F.count("*").alias("n"))
    vintage = last.join(counted, "source", "left").select("source", F.lit("source_vintage").alias("check_name"), "outcome", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    key = table(spark, sf_dir, "orders").select(F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R"), F.lit("X")), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("source"), F.when(F.col("o_custkey") % 19 != 0, F.col("o_orderkey") - F.col("o_orderkey") % 8 + F.col("o_orderkey") % 4).alias("ident"), F.col("o_orderdate").cast("date").alias("day"))
    groups = key.where("ident is not null").groupBy("source", "ident").agg(F.count("*").alias("n")).where("n > 1")
    parts = [
        records,
        S.group_check(count_duplicates(published, "uid", "source", "duplicate_uid"), "source", "duplicate_uid", tri_state(F.col("duplicate_uid")), F.sum("n_rows")),
        shapes,
        S.group_check(counted_pairs(spark, sf_dir, "source"), "source", "geometry_overlap", outcome(), F.sum("n_pairs")),
        vintage,
        S.group_check(rejected, "source", "rejection", F.col("rejection_reason")),
        S.group_check(recon, "source", "reconciliation", F.col("reconciliation_class")),
        S.group_check(recon.where("value_drift"), "source", "value_drift", F.lit("drifted")),
        S.status_coverage(recon, "source", FIELD_NAMES),
        S.group_check(groups, "source", "key_duplicate_groups", F.lit("duplicate_group")),
        S.group_check(key.where("ident is null"), "source", "key_unidentified", F.lit("unidentified")),
        # The outcome is the date itself; orders are counted once.
        key.groupBy("source").agg(F.max("day").cast("string").alias("outcome"), F.count("*").alias("n")).select("source", F.lit("key_vintage").alias("check_name"), "outcome", "n"),
    ]
    totals = published.groupBy("source").agg(F.count("*").alias("total_records"))
    long = S.long_scorecard(parts, totals, "source")
    described = registry_frame(spark, CHECKS, ("check_name", "check_description"))
    return long.join(F.broadcast(described), "check_name", "left")


_OUTCOMES = [
    ("unit_price_off", "CASE WHEN unit_price_off THEN 'flagged' WHEN unit_price_off IS NULL THEN 'not_measurable' ELSE 'clear' END"),
    ("discount_high", "CASE WHEN discount_high THEN 'flagged' WHEN discount_high IS NULL THEN 'not_measurable' ELSE 'clear' END"),
    ("duplicate_uid", "CASE WHEN uid IS NOT NULL AND count(*) OVER (PARTITION BY uid) > 1 THEN 'flagged' ELSE 'clear' END"),
    ("discount_coverage", "CASE WHEN discount > 0 THEN 'measurable' ELSE 'no_roll_figure' END"),
    ("status_coverage", "CASE WHEN status = 'F' THEN 'derived' ELSE 'unmapped' END"),
    ("attribute_completeness", "CASE WHEN status <> 'O' OR discount IS NOT NULL THEN 'complete' ELSE 'attribute_sparse' END"),
    ("merge_provenance", "CASE WHEN source_record_count > 1 THEN 'merged' ELSE 'single' END"),
    ("stacked_components", "CASE WHEN is_final THEN 'stacked' ELSE 'not_stacked' END"),
]
LONG_SQL = (
    JUDGED_SQL
    + ","
    + RECONCILED_SQL
    + ","
    + pairs_sql(SOURCE_SQL)
    + ",\nanswer AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' ELSE 'X' END AS source, CASE WHEN o_custkey % 19 <> 0 THEN o_orderkey - o_orderkey % 8 + o_orderkey % 4 END AS ident, CAST(o_orderdate AS DATE) AS day FROM orders),\nblocks AS (\n"
    + "\nUNION ALL ".join(f"SELECT source, '{n}' AS check_name, outcome, count(*) AS n FROM (SELECT source, {o} AS outcome FROM judged WHERE rejection_reason IS NULL) GROUP BY ALL" for n, o in _OUTCOMES)
    + f"""
UNION ALL SELECT {SOURCE_SQL}, 'geometry_valid', CASE WHEN p_partkey % 7 < 4 THEN 'valid' ELSE 'invalid' END, count(*) FROM part WHERE p_partkey % 7 < 6 GROUP BY ALL
UNION ALL SELECT {SOURCE_SQL}, 'geometry_repaired', 'repaired', count(*) FROM part WHERE p_partkey % 7 IN (1, 2, 3) GROUP BY ALL
UNION ALL SELECT p_brand, 'geometry_overlap', CASE WHEN unflagged_coincident THEN 'coincident_unflagged' ELSE overlap_class END, count(*) FROM classed GROUP BY ALL
UNION ALL SELECT l_returnflag, 'source_vintage', CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR), coalesce((SELECT count(DISTINCT record_key) FROM judged WHERE rejection_reason IS NULL AND source = l_returnflag), 0) FROM lineitem GROUP BY l_returnflag
""" + """
UNION ALL SELECT source, 'rejection', rejection_reason, count(*) FROM judged WHERE rejection_reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT source, 'reconciliation', reconciliation_class, count(*) FROM recon GROUP BY ALL
UNION ALL SELECT source, 'value_drift', 'drifted', count(*) FROM recon WHERE value_drift GROUP BY ALL
"""
    + "\n".join(f"UNION ALL SELECT source, 'field_coverage', '{f}:' || {f}_status, count(*) FROM recon WHERE {f}_status IN ('ours_absent', 'theirs_absent') GROUP BY ALL" for f in FIELD_NAMES)
    + """
UNION ALL SELECT source, 'key_duplicate_groups', 'duplicate_group', count(*) FROM (SELECT source, ident FROM answer WHERE ident IS NOT NULL GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL
UNION ALL SELECT source, 'key_unidentified', 'unidentified', count(*) FROM answer WHERE ident IS NULL GROUP BY ALL
UNION ALL SELECT source, 'key_vintage', CAST(max(day) AS VARCHAR), count(*) FROM answer GROUP BY source),
long AS (
  SELECT blocks.*, total_records, outcome IN ('flagged', 'coincident_unflagged', 'both_differ', 'attribute_sparse', 'unmapped') AS is_adverse
  FROM blocks JOIN (SELECT source, count(*) AS total_records FROM judged WHERE rejection_reason IS NULL GROUP BY 1) USING (source) WHERE outcome IS NOT NULL)"""
)

WIDE = {
    "both_match": ("reconciliation", "both_match"),
    "both_differ": ("reconciliation", "both_differ"),
    "ours_only": ("reconciliation", "ours_only"),
    "theirs_only": ("reconciliation", "theirs_only"),
    "unit_price_flagged": ("unit_price_off", "flagged"),
    "discount_unmeasured": ("discount_high", "not_measurable"),
    "unmapped": ("status_coverage", "unmapped"),
    "attribute_sparse": ("attribute_completeness", "attribute_sparse"),
    "merged_records": ("merge_provenance", "merged"),
    "rejected_records": ("rejection", "%"),
    "values_they_lack": ("field_coverage", "%:theirs_absent"),
    "values_we_lack": ("field_coverage", "%:ours_absent"),
    "drifted": ("value_drift", "drifted"),
}
RATES = {
    "pct_agreement": (["both_match"], ["both_match", "both_differ", "ours_only", "theirs_only"]),
    "pct_sparse": (["attribute_sparse"], ["total_records"]),
    "pct_flagged": (["unit_price_flagged"], ["total_records"]),
    "pct_unmapped": (["unmapped"], ["total_records"]),
    "pct_rejected": (["rejected_source_rows"], ["rejected_source_rows", "published_source_rows"]),
}


def scorecard_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, recon = _layers(spark, sf_dir)
    published, rejected = split(judged)
    wide = S.wide_scorecard(_long(spark, sf_dir, judged, recon), "source", WIDE)
    for d, n in ((published, "published_source_rows"), (rejected, "rejected_source_rows")):
        wide = wide.join(d.groupBy("source").agg(F.sum("source_record_count").cast("long").alias(n)), "source", "left").withColumn(n, F.coalesce(n, F.lit(0)).cast("long"))
    return S.with_rates(wide, RATES).orderBy("source")


def _cell(name: str, check: str, outcome: str) -> str:
    fits = f"outcome LIKE '{outcome}'" if "%" in outcome else f"outcome = '{outcome}'"
    return f"CAST(coalesce(sum(n) FILTER (check_name = '{check}' AND {fits}), 0) AS BIGINT) AS {name}"


def _rate(name: str, above: list[str], below: list[str]) -> str:
    a, b = " + ".join(above), " + ".join(below)
    return f"CAST((20000 * ({a}) + ({b})) // nullif(2 * ({b}), 0) AS DOUBLE) / 100 AS {name}"


WIDE_SQL = f"""
{LONG_SQL},
wide AS (
  SELECT source, max(total_records) AS total_records, {", ".join(_cell(k, *v) for k, v in WIDE.items())},
         CAST(coalesce((SELECT sum(source_record_count) FROM judged j WHERE j.source = long.source AND rejection_reason IS NULL), 0) AS BIGINT) AS published_source_rows,
         CAST(coalesce((SELECT sum(source_record_count) FROM judged j WHERE j.source = long.source AND rejection_reason IS NOT NULL), 0) AS BIGINT) AS rejected_source_rows
  FROM long GROUP BY source),
rated AS (SELECT *, {", ".join(_rate(k, *v) for k, v in RATES.items())} FROM wide)"""


def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All statuses of each field against the answer key, in one pass."""
    recon = reconciled(spark, sf_dir)
    return S.record_checks(recon, "source", {f: F.col(f"{f}_status") for f in [*FIELD_NAMES, "price"]}).withColumnsRenamed({"check_name": "field", "outcome": "status"})


FIELD_COVERAGE = f"WITH {RECONCILED_SQL}\n" + "\nUNION ALL ".join(f"SELECT source, '{f}' AS field, {f}_status AS status, count(*) AS n FROM recon GROUP BY ALL" for f in [*FIELD_NAMES, "price"])


def kpi_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.headline(scorecard_wide(spark, sf_dir), ["total_records", "both_match", "both_differ", "rejected_source_rows"], ["pct_agreement", "pct_rejected"])


KPI_ROLLUP = f"""
WITH {WIDE_SQL}
SELECT {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("total_records", "both_match", "both_differ", "rejected_source_rows"))},
       {", ".join(f"{f}({c}) AS {c}_{f}" for c in ("pct_agreement", "pct_rejected") for f in ("min", "max"))}
FROM rated
"""


def scorecard_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks that cover every record, summed against the totals; recomputed answer-key counts against the scorecard."""
    from ..operators.contracts import expect_true, partition_checks, violation_counts

    long = scorecard_long(spark, sf_dir)
    whole = ["unit_price_off", "discount_high", "duplicate_uid", "discount_coverage", "status_coverage", "attribute_completeness", "merge_provenance", "stacked_components"]
    counted = long.where("check_name = 'reconciliation'").agg(F.sum("n").alias("n"))
    keys = theirs(spark, sf_dir).select("uid").union(table(spark, sf_dir, "lineitem").select("l_orderkey")).distinct().where("uid % 4 <> 3").agg(F.count("*").alias("m"))
    return violation_counts({"checks_sum_to_total": partition_checks(long, "source", whole), "classes_cover_keys": expect_true(counted.crossJoin(F.broadcast(keys)), F.col("n") == F.col("m"))})  # one row each


SCORECARD_CONSISTENCY = f"""
WITH {LONG_SQL},
sums AS (SELECT source, check_name, sum(n) AS n, max(total_records) AS m FROM long
         WHERE check_name IN ('unit_price_off', 'discount_high', 'duplicate_uid', 'discount_coverage', 'status_coverage', 'attribute_completeness', 'merge_provenance', 'stacked_components') GROUP BY ALL),
keys AS (SELECT count(*) AS m FROM (SELECT o_orderkey AS uid FROM orders WHERE o_custkey % 10 <> 3 UNION SELECT l_orderkey FROM lineitem) WHERE uid % 4 <> 3)
SELECT 'checks_sum_to_total' AS contract, 'error' AS severity, count(*) AS violations FROM sums WHERE n <> m
UNION ALL SELECT 'classes_cover_keys', 'error', CASE WHEN (SELECT sum(n) FROM long WHERE check_name = 'reconciliation') = m THEN 0 ELSE 1 END FROM keys
"""

QUERIES = {
    "scorecard_long": scorecard_long,
    "scorecard_wide": scorecard_wide,
    "field_coverage": field_coverage,
    "kpi_rollup": kpi_rollup,
    "scorecard_consistency": scorecard_consistency,
}
SQL = {
    "scorecard_long": f"WITH {LONG_SQL} SELECT long.*, CASE check_name " + " ".join(f"WHEN '{c.id}' THEN '{c.description}'" for c in CHECKS) + " END AS check_description FROM long",
    "scorecard_wide": f"WITH {WIDE_SQL} SELECT * FROM rated",
    "field_coverage": FIELD_COVERAGE,
    "kpi_rollup": KPI_ROLLUP,
    "scorecard_consistency": SCORECARD_CONSISTENCY,
}
