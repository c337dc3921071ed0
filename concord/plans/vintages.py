"""Histories, codes and labels, freshness and drift of schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import date_of_millis, without_code
from ..operators import vintage as V
from ..operators.conform import schema_drift
from .common import table


def latest_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each user's last day, and whether that day is the last of all."""
    e = table(spark, sf_dir, "events").withColumn("day", date_of_millis(F.unix_millis(F.col("ts").cast("timestamp"))))
    own = V.latest_capture(e, "day", ["user_id"])
    last = V.latest_capture(e.select("day").distinct(), "day").select("day", F.lit(True).alias("of_last_day"))
    return own.join(last, "day", "left").select("user_id", "event_id", "event_type", "day", F.coalesce("of_last_day", F.lit(False)).alias("of_last_day"))


LATEST_CAPTURE = """
WITH e AS (SELECT *, CAST(ts AS DATE) AS day FROM events)
SELECT user_id, event_id, event_type, day, day = (SELECT max(day) FROM e) AS of_last_day
FROM e WHERE (user_id, day) IN (SELECT (user_id, max(day)) FROM e GROUP BY user_id)
"""


def name_code_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations given by number or by a name written in some way; names that nobody knows resolve to nothing."""
    n = table(spark, sf_dir, "nation")
    names = n.where("n_nationkey <> 7").select((F.col("n_nationkey") + 1).cast("string").alias("code"), F.initcap(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("label"))
    published = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    value = F.when(F.col("c_custkey") % 2 == 0, (F.col("n_nationkey") + 1).cast("string")).otherwise(F.replace("n_name", F.lit("_"), F.lit("")))
    return V.resolve_codes(published.select("c_custkey", value.alias("value")), "value", names, 3)


NAME_CODE_RESOLVE = """
WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(n_nationkey + 1 AS VARCHAR) ELSE replace(n_name, '_', '') END AS value FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, value, CASE WHEN c_custkey % 2 = 0 OR c_nationkey <> 7 THEN lpad(CAST(c_nationkey + 1 AS VARCHAR), 3, '0') END AS code, c_custkey % 2 = 1 AS resolved_from_name FROM c
"""


def derived_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crosswalk that the parts themselves show, joined back on a computed key where it is a function."""
    p = table(spark, sf_dir, "part").withColumn("original", F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string")))
    crosswalk = V.derived_crosswalk(p.withColumnRenamed("p_type", "code"), "original", "code")
    padded = F.lpad(F.col("p_size").cast("string"), 3, "0")
    key = F.concat("p_brand", F.lit("-"), F.ltrim(padded, F.lit("0")))
    return V.with_crosswalk(p.select("p_partkey", "p_brand", "p_size"), crosswalk, key, "original", "code").drop("p_size", "p_brand")


DERIVED_CROSSWALK = """
WITH x AS (SELECT p_brand || '-' || p_size AS original, min(p_type) AS code FROM part GROUP BY 1 HAVING count(DISTINCT p_type) = 1)
SELECT p_partkey, code, CASE WHEN code IS NOT NULL THEN 'derived' ELSE 'unmapped' END AS code_method FROM part LEFT JOIN x ON p_brand || '-' || p_size = original
"""


def label_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    published = r.where("r_regionkey < 3").select("r_regionkey", without_code(F.concat(F.col("r_regionkey").cast("string"), F.lit(" - "), F.col("r_name"))).alias("label"))
    fallback = r.select("r_regionkey", F.concat(F.lit("Region "), F.col("r_regionkey").cast("string")).alias("label"))
    labels = V.labels_with_fallback(published, fallback, "r_regionkey")
    return table(spark, sf_dir, "nation").join(labels, F.col("n_regionkey") == F.col("r_regionkey"), "left").groupBy("label", "label_source").agg(F.count("*").alias("n"))


LABEL_FALLBACK = """
SELECT CASE WHEN n_regionkey < 3 THEN r_name ELSE 'Region ' || n_regionkey END AS label, CASE WHEN n_regionkey < 3 THEN 'published' ELSE 'fallback' END AS label_source, count(*) AS n
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
"""


def freshness_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers are (event type, user mod 10); what was recorded ends at a cut-off, and for some layers earlier."""
    e = table(spark, sf_dir, "events").withColumn("layer", F.concat("event_type", F.lit("-"), (F.col("user_id") % 10).cast("string")))
    remote = e.groupBy("layer").agg(F.max("ts").alias("last")).select("layer", F.when(~F.col("layer").endswith("3"), F.col("last")).alias("edited_at"))
    recorded = e.where("not layer like '%5'").where("event_id % 100 < 98").select("layer", F.col("ts").alias("edited_at"))
    decisions = V.freshness(remote, recorded, "layer")
    return decisions.select("layer", "reason", "changed").crossJoin(F.broadcast(V.should_run(decisions)))  # one row


FRESHNESS_DECISION = """
WITH e AS (SELECT *, event_type || '-' || user_id % 10 AS layer FROM events),
     remote AS (SELECT layer, CASE WHEN NOT layer LIKE '%3' THEN max(ts) END AS r FROM e GROUP BY layer),
     recorded AS (SELECT layer, max(ts) AS t FROM e WHERE NOT layer LIKE '%5' AND event_id % 100 < 98 GROUP BY layer),
     d AS (SELECT layer, CASE WHEN r IS NULL THEN 'remote_unknown' WHEN t IS NULL THEN 'never_recorded' WHEN r > t THEN 'edited' ELSE 'unchanged' END AS reason FROM remote LEFT JOIN recorded USING (layer))
SELECT layer, reason, reason <> 'unchanged' AS changed, (SELECT bool_or(reason <> 'unchanged') FROM d) AS run FROM d
"""


def schema_drift_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of names and types, made of the small and of the large parts."""
    p = table(spark, sf_dir, "part").withColumn("field_name", F.concat("p_brand", F.lit("/"), "p_name"))
    snapshot = lambda where: p.where(where).groupBy("field_name").agg(F.max("p_type").alias("field_type"))
    return schema_drift(snapshot("p_size <= 25"), snapshot("p_size > 25"))


SCHEMA_DRIFT = """
WITH o AS (SELECT p_brand || '/' || p_name AS field_name, max(p_type) AS old_type FROM part WHERE p_size <= 25 GROUP BY 1),
     n AS (SELECT p_brand || '/' || p_name AS field_name, max(p_type) AS new_type FROM part WHERE p_size > 25 GROUP BY 1)
SELECT * FROM (SELECT field_name, old_type, new_type, CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed' WHEN old_type <> new_type THEN 'retyped' END AS change FROM o FULL JOIN n USING (field_name)) WHERE change IS NOT NULL
"""

QUERIES = {
    "latest_capture": latest_capture,
    "name_code_resolve": name_code_resolve,
    "derived_crosswalk": derived_crosswalk,
    "label_fallback": label_fallback,
    "freshness_decision": freshness_decision,
    "schema_drift": schema_drift_,
}
SQL = {
    "latest_capture": LATEST_CAPTURE,
    "name_code_resolve": NAME_CODE_RESOLVE,
    "derived_crosswalk": DERIVED_CROSSWALK,
    "label_fallback": LABEL_FALLBACK,
    "freshness_decision": FRESHNESS_DECISION,
    "schema_drift": SCHEMA_DRIFT,
}
