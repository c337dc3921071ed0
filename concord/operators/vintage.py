"""Reference data with a history: latest captures, names to codes, crosswalks, labels, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import code_or_name, squeezed


def latest_capture(history: DataFrame, run: str, keys: list[str] | None = None) -> DataFrame:
    """The rows of the last run, overall or by key (all rows of that run, ties included)."""
    last = history.groupBy(*(keys or [])).agg(F.max(run).alias("_last"))
    condition = F.col(run) == F.col("_last")
    if not keys:
        return history.crossJoin(F.broadcast(last)).where(condition).drop("_last")  # one row
    return history.join(last, keys).where(condition).drop("_last")


def resolve_codes(df: DataFrame, value: str, names: DataFrame, width: int) -> DataFrame:
    """Adds code and resolved_from_name; ``names`` has code and label, joined without case or spaces."""
    known = names.select(F.col("code").alias("_code"), squeezed(F.col("label")).alias("_label"))
    code, by_name = code_or_name(F.col(value), width, F.col("_code"))
    out = df.join(known, squeezed(F.col(value)) == F.col("_label"), "left")
    return out.withColumn("code", code).withColumn("resolved_from_name", by_name).drop("_code", "_label")


def derived_crosswalk(df: DataFrame, original: str, code: str) -> DataFrame:
    """The distinct pairs that a table itself shows."""
    return df.where(F.col(original).isNotNull() & F.col(code).isNotNull()).select(original, code).distinct()


def not_a_function(crosswalk: DataFrame, original: str, code: str) -> DataFrame:
    """Originals with several codes (a join on them would multiply rows)."""
    return crosswalk.groupBy(original).agg(F.countDistinct(code).alias("n")).where("n > 1")


def with_crosswalk(df: DataFrame, crosswalk: DataFrame, key: Column, original: str, code: str) -> DataFrame:
    """Adds ``code`` and ``<code>_method`` (derived or unmapped); originals that aren't a function map to nothing."""
    sound = crosswalk.join(not_a_function(crosswalk, original, code).select(original), original, "left_anti").withColumnRenamed(original, "_original")
    out = df.join(sound, key == F.col("_original"), "left").drop("_original")
    return out.withColumn(f"{code}_method", F.when(F.col(code).isNotNull(), "derived").otherwise("unmapped"))


def labels_with_fallback(published: DataFrame, fallback: DataFrame, code: str) -> DataFrame:
    """Published labels win; fallback labels for codes that have none."""
    rest = fallback.join(published.where(F.col(code).isNotNull()).select(code), code, "left_anti")
    return published.withColumn("label_source", F.lit("published")).unionByName(rest.withColumn("label_source", F.lit("fallback")), allowMissingColumns=True)


def recorded_edits(spark: SparkSession, name: str, layer: str, column: str) -> DataFrame:
    """layer, edited_at of a table of what was recorded; no rows, so nothing known, without the table or one of its columns."""
    if spark.catalog.tableExists(name):
        found = spark.table(name)
        if {layer, column} <= set(found.columns):
            return found.select(layer, F.col(column).cast("timestamp").alias("edited_at"))
    return spark.createDataFrame([], f"`{layer}` string, edited_at timestamp")


def freshness(remote: DataFrame, recorded: DataFrame, layer: str, force: bool = False) -> DataFrame:
    """A decision per layer; only proof that nothing changed allows a skip.

    ``remote``: layer, edited_at (null: unknown).  ``recorded``: layer, edited_at, many rows a layer.
    """
    last = recorded.groupBy(layer).agg(F.max("edited_at").alias("recorded_at"))
    out = remote.select(layer, F.col("edited_at").alias("remote_at")).join(last, layer, "left")
    reason = (
        F.when(F.lit(force), "forced")
        .when(F.col("remote_at").isNull(), "remote_unknown")
        .when(F.col("recorded_at").isNull(), "never_recorded")
        .when(F.col("remote_at") > F.col("recorded_at"), "edited")
        .otherwise("unchanged")
    )
    return out.withColumn("reason", reason).withColumn("changed", F.col("reason") != "unchanged")


def should_run(decisions: DataFrame) -> DataFrame:
    """One row: whether any layer changed (no layers at all: run)."""
    return decisions.agg(F.coalesce(F.bool_or("changed"), F.lit(True)).alias("run"))
