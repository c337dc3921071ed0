"""Reconciliation with an answer key: both sides to one grain, a full outer join, a status per field."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import field_status


@dataclass(frozen=True)
class Comparable:
    """A field that both sides have.

    ``how``: ``sum``, or ``representative`` (the smallest value, with the number of distinct ones).
    ``drift``: expected to differ with time; ``incomparable``: reported but never counted.
    """

    name: str
    how: str = "representative"
    text: bool = False
    drift: bool = False
    incomparable: bool = False


def classifying(fields: Sequence[Comparable]) -> list[Comparable]:
    """The fields whose disagreement decides the class of a record."""
    return [f for f in fields if not f.drift and not f.incomparable]


def collapse(df: DataFrame, key: str, fields: Sequence[Comparable], side: str) -> DataFrame:
    """One row per key with ``side_<field>`` (and ``side_<field>_variants``) and ``side_records``.

    Rows that are alike in key and representatives are summed first, so that a key of many rows is few.  What is left is dealt by
    key once; distinct values are those that differ from the one before in order, so that neither they nor the join by key move
    a row again, and no row is copied for each counter.
    """
    summed = [f.name for f in fields if f.how == "sum"]
    apart = [f.name for f in fields if f.how != "sum"]
    alike = df.where(F.col(key).isNotNull()).groupBy(key, *apart).agg(F.count("*").alias("_records"), *[F.sum(c).alias(c) for c in summed])
    rows = alike.repartition(key)
    for name in apart:
        before = F.lag(name).over(W.partitionBy(key).orderBy(name))
        rows = rows.withColumn(f"_new_{name}", (F.col(name).isNotNull() & ~F.col(name).eqNullSafe(before)).cast("long"))
    columns: list[Column] = []
    for f in fields:
        c = F.col(f.name)
        # A sum of sums has the type of the sum.
        columns.append((F.sum(c).cast(alike.schema[f.name].dataType) if f.how == "sum" else F.min(c)).alias(f"{side}_{f.name}"))
        if f.how != "sum":
            columns.append(F.coalesce(F.sum(f"_new_{f.name}"), F.lit(0)).cast("long").alias(f"{side}_{f.name}_variants"))
    return rows.groupBy(key).agg(F.sum("_records").alias(f"{side}_records"), *columns)


def record_class(statuses: list[Column]) -> Column:
    return (
        F.when(F.col("ours_absent") & F.col("theirs_absent"), "impossible")
        .when(F.col("ours_absent"), "theirs_only")
        .when(F.col("theirs_absent"), "ours_only")
        .when(F.lit("disagree").isin(*statuses) if statuses else F.lit(False), "both_differ")
        .otherwise("both_match")
    )


def reconcile(ours: DataFrame, theirs: DataFrame, key: str, fields: Sequence[Comparable]) -> DataFrame:
    """Collapses both sides before the join, so the join is one to one.

    Adds ours_absent, theirs_absent, ``<field>_status``, reconciliation_class and value_drift.
    """
    a, b = collapse(ours, key, fields, "ours"), collapse(theirs, key, fields, "theirs")
    both = a.join(b, key, "full_outer").withColumn("ours_absent", F.col("ours_records").isNull()).withColumn("theirs_absent", F.col("theirs_records").isNull())
    both = both.select("*", *[field_status(F.col(f"ours_{f.name}"), F.col(f"theirs_{f.name}"), f.text).alias(f"{f.name}_status") for f in fields])
    statuses = [F.col(f"{f.name}_status") for f in classifying(fields)]
    drift = [F.col(f"{f.name}_status") == "disagree" for f in fields if f.drift]
    return both.withColumn("reconciliation_class", record_class(statuses)).withColumn("value_drift", reduce(lambda x, y: x | y, drift, F.lit(False)))


def with_vintages(reconciled: DataFrame, source: str, ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Adds our_published, their_published (one row per source on each side) and the gap in days."""
    out = reconciled.join(ours.withColumnRenamed("published", "our_published"), source, "left").join(theirs.withColumnRenamed("published", "their_published"), source, "left")
    return out.withColumn("vintage_gap_days", F.datediff("our_published", "their_published"))


def disagreement_text(fields: Sequence[Comparable]) -> Column:
    """``field: ours ≠ theirs`` for each field that disagrees, null if none does."""
    parts = [F.when(F.col(f"{f.name}_status") == "disagree", F.concat(F.lit(f"{f.name}: "), F.col(f"ours_{f.name}").cast("string"), F.lit(" ≠ "), F.col(f"theirs_{f.name}").cast("string"))) for f in fields]
    return F.nullif(F.concat_ws("; ", *parts), F.lit(""))
