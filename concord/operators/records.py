"""Rows that are one record are merged, with the count of rows behind each record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

REDUCERS = {
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "any": F.bool_or,
    "every": F.bool_and,
    # Exact where parts are disjoint or touch; overlapping parts are found by operators.overlap.
    "union": lambda c: F.nullif(F.flatten(F.collect_list(c)), F.array().cast("array<array<array<struct<x:double,y:double>>>>")),
}


def merge_records(df: DataFrame, key: str, signature: str, reducers: Mapping[str, str | tuple[str, Column]], count: str = "source_record_count") -> DataFrame:
    """One row per record key; rows with a null key are merged only with rows of the same signature.

    ``reducers``: output column -> reducer, or (reducer, column).  One aggregate, partial before the
    shuffle and final after it.
    """
    guard = "_guard"
    columns = []
    for name, how in reducers.items():
        reducer, column = (how, F.col(name)) if isinstance(how, str) else how
        columns.append(REDUCERS[reducer](column).alias(name))
    grouped = df.groupBy(F.col(key), F.when(F.col(key).isNull(), F.col(signature)).alias(guard))
    return grouped.agg(*columns, F.count("*").alias(count)).drop(guard)


def duplicated_ids(df: DataFrame, ident: str) -> DataFrame:
    """Ids with more than one row, and how many."""
    return df.where(F.col(ident).isNotNull()).groupBy(ident).agg(F.count("*").alias("n")).where("n > 1")


def flag_duplicates(df: DataFrame, ident: str, flag: str = "duplicate_id") -> DataFrame:
    """Every row whose id more than one row has; the counts are aggregated before the join."""
    again = duplicated_ids(df, ident).select(ident, F.lit(True).alias(flag))
    # Rows without an id, however many, stay where they are: the join would send them to one task.
    known = df.where(F.col(ident).isNotNull()).join(again, ident, "left").select(*df.columns, F.coalesce(flag, F.lit(False)).alias(flag))
    return known.unionByName(df.where(F.col(ident).isNull()).withColumn(flag, F.lit(False)))


def count_duplicates(df: DataFrame, ident: str, by: str, flag: str = "duplicate_id") -> DataFrame:
    """What flag_duplicates() flags, counted: ``by``, the flag, n_rows and n_keys (distinct ids).

    Rows are counted by id and ``by`` first and not joined back, so that an id of many rows, or no id, is one row for each ``by``.
    """
    one = df.groupBy(ident, by).agg(F.count("*").alias("n"))
    again = F.col(ident).isNotNull() & (F.sum("n").over(W.partitionBy(ident)) > 1)
    counted = one.withColumn(flag, again).groupBy(by, flag).agg(F.sum("n").alias("n_rows"), F.count(ident).alias("n_keys"))
    return counted.withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("long"))
