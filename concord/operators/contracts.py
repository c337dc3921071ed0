"""Data contracts: each gives the rows that break it as a DataFrame, empty if it holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G


def expect_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def expect_unique(df: DataFrame, *columns: str) -> DataFrame:
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(present).groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def expect_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).select(column).distinct()


def expect_known(df: DataFrame, column: str, registry: DataFrame, key: str) -> DataFrame:
    """Values that the registry doesn't have."""
    return df.where(F.col(column).isNotNull()).select(F.col(column).alias(key)).distinct().join(registry.select(key), key, "left_anti")


def expect_true(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false or unknown."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def row_conservation(staged: DataFrame, published: DataFrame, rejected: DataFrame, source: str, weight: str = "source_record_count") -> DataFrame:
    """Sources whose staged rows aren't the rows behind published and rejected records."""
    n = staged.groupBy(source).agg(F.count("*").alias("staged"))
    add = lambda d, name: d.groupBy(source).agg(F.sum(weight).cast("long").alias(name))
    both = n.join(add(published, "published"), source, "full_outer").join(add(rejected, "rejected"), source, "full_outer")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("staged", "published", "rejected")]
    return both.select(source, *zero).where("staged <> published + rejected")


def reject_rate(staged: DataFrame, rejected: DataFrame, source: str, most: float, weight: str = "source_record_count") -> DataFrame:
    """Sources that lose ``most`` of their staged rows or more (source rows on both sides of the ratio)."""
    n = staged.groupBy(source).agg(F.count("*").alias("staged"))
    lost = rejected.groupBy(source).agg(F.sum(weight).cast("long").alias("rejected"))
    return n.join(lost, source).where(F.col("rejected") / F.col("staged") >= most)


def balance(ours: DataFrame, theirs: DataFrame, reconciled: DataFrame, key: str, source: str) -> DataFrame:
    """Sources for which the full outer join created or destroyed keys."""
    keys = lambda d, n: d.where(F.col(key).isNotNull()).groupBy(source).agg(F.countDistinct(key).alias(n))
    got = reconciled.groupBy(source).agg(F.count_if(~F.col("ours_absent")).alias("got_ours"), F.count_if(~F.col("theirs_absent")).alias("got_theirs"))
    both = keys(ours, "ours").join(keys(theirs, "theirs"), source, "full_outer").join(got, source, "full_outer")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("ours", "theirs", "got_ours", "got_theirs")]
    return both.select(source, *zero).where("ours <> got_ours or theirs <> got_theirs")


def partition_checks(long: DataFrame, source: str, checks: Sequence[str]) -> DataFrame:
    """Checks that should cover every record of a source but don't add up to its total."""
    return long.where(F.col("check_name").isin(*checks)).groupBy(source, "check_name").agg(F.sum("n").cast("long").alias("n"), F.max("total_records").alias("total_records")).where("n <> total_records")


def geometry_contracts(df: DataFrame, tagged: str, srid: int) -> dict[str, DataFrame]:
    """What a map's geometries must be: there, not empty, in one reference system and valid."""
    t = F.col(tagged)
    there = df.where(t.isNotNull())
    return {
        "geometry_present": df.where(t.isNull()),
        "geometry_not_empty": there.where(G.is_empty(G.shape(t))),
        "geometry_srid": there.where(G.srid(t) != srid),
        "geometry_valid": there.withColumn("_valid", G.is_valid(G.shape(t))).where("not _valid"),
    }


def violation_counts(contracts: Mapping[str, DataFrame], severity: Mapping[str, str] | None = None) -> DataFrame:
    """(contract, severity, violations), one row for each contract."""
    severity = severity or {}
    parts = [d.agg(F.count("*").alias("violations")).select(F.lit(n).alias("contract"), F.lit(severity.get(n, "error")).alias("severity"), "violations") for n, d in contracts.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
