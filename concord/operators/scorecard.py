"""The quality scorecard: long (source, check, outcome, count), wide, and headline figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import percent

#: Outcomes that count against a source.
ADVERSE = ("flagged", "coincident_unflagged", "both_differ", "attribute_sparse", "unmapped")


def record_checks(df: DataFrame, source: str, checks: Mapping[str, Column], n: str | None = None) -> DataFrame:
    """All checks of one row each in a single pass: rows of the same outcomes are counted, and the outcomes of these unpivoted.

    A check whose outcome is null doesn't count the row.  ``n``: a column of the number of records that a row stands for.
    """
    names = [f"_{i}" for i in range(len(checks))]
    alike = df.select(F.col(source), *[c.cast("string").alias(a) for a, c in zip(names, checks.values())], *([F.col(n).alias("_n")] if n else []))
    alike = alike.groupBy(source, *names).agg((F.sum("_n") if n else F.count("*")).alias("n"))
    outcomes = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(a).alias("outcome")) for a, name in zip(names, checks)])
    rows = alike.select(source, F.explode(outcomes).alias("c"), "n").where("c.outcome is not null")
    return rows.groupBy(source, F.col("c.check_name").alias("check_name"), F.col("c.outcome").alias("outcome")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))


def group_check(df: DataFrame, source: str, name: str, outcome: Column, n: Column | None = None) -> DataFrame:
    """A check over another grain (pairs, groups, the answer key)."""
    return df.groupBy(source, F.lit(name).alias("check_name"), outcome.cast("string").alias("outcome")).agg((n if n is not None else F.count("*")).alias("n"))


def status_coverage(reconciled: DataFrame, source: str, fields: Sequence[str], name: str = "field_coverage") -> DataFrame:
    """``<field>:<status>`` for the two statuses that mean missing."""
    outcomes = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"{f}_status").alias("s")) for f in fields])
    rows = reconciled.select(source, F.explode(outcomes).alias("c")).where(F.col("c.s").isin("ours_absent", "theirs_absent"))
    return group_check(rows, source, name, F.concat("c.f", F.lit(":"), "c.s"))


def long_scorecard(parts: Sequence[DataFrame], totals: DataFrame, source: str, adverse: Sequence[str] = ADVERSE) -> DataFrame:
    """All blocks under one another; sources without any published row go with the inner join to the totals."""
    every = reduce(lambda a, b: a.unionByName(b), parts)
    return every.join(totals.select(source, "total_records"), source).withColumn("is_adverse", F.col("outcome").isin(*adverse))


def wide_scorecard(long: DataFrame, source: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per source; ``columns``: name -> (check, outcome, where % stands for anything). Missing counts are 0.

    Several outcomes that fit one column are summed.
    """
    fits = lambda o: F.col("outcome").like(o) if "%" in o else F.col("outcome") == o
    cells = [F.coalesce(F.sum(F.when((F.col("check_name") == c) & fits(o), F.col("n"))), F.lit(0)).cast("long").alias(name) for name, (c, o) in columns.items()]
    return long.groupBy(source).agg(F.max("total_records").alias("total_records"), *cells)


def with_rates(wide: DataFrame, rates: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """Percentages: name -> (columns above, columns below the line), each summed."""
    add = lambda cs: reduce(lambda a, b: a + b, [F.col(c) for c in cs])
    return wide.select("*", *[percent(add(a), add(b)).alias(n) for n, (a, b) in rates.items()])


def headline(wide: DataFrame, sums: Sequence[str], ranges: Sequence[str]) -> DataFrame:
    """One row over all sources: sums, and the lowest and highest of the rates."""
    return wide.agg(*[F.sum(c).cast("long").alias(c) for c in sums], *[f(c).alias(f"{c}_{n}") for c in ranges for n, f in (("min", F.min), ("max", F.max))])
