"""Ordered rejection rules, flags that don't reject, and the split into published and quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ordered_case


@dataclass(frozen=True)
class Rule:
    id: str
    description: str
    when: str  # SQL condition


def rejection_reason(rules: Sequence[Rule]) -> Column:
    """The id of the first rule that holds, else null."""
    return ordered_case((F.expr(r.when), r.id) for r in rules)


def flags(rules: Sequence[Rule]) -> list[Column]:
    """One boolean per rule; null where the rule can't be measured."""
    return [F.expr(r.when).cast("boolean").alias(r.id) for r in rules]


def judge(df: DataFrame, rejections: Sequence[Rule], flag_rules: Sequence[Rule] = (), reason: str = "rejection_reason") -> DataFrame:
    return df.select("*", rejection_reason(rejections).alias(reason), *flags(flag_rules))


def split(df: DataFrame, reason: str = "rejection_reason") -> tuple[DataFrame, DataFrame]:
    """(published, quarantined): every row is in exactly one of them."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def registry_frame(spark: SparkSession, rules: Sequence[Rule], names: tuple[str, str] = ("rejection_reason", "description")) -> DataFrame:
    """The registry as an inline relation of fixed size."""
    rows = F.array(*[F.struct(F.lit(r.id).alias(names[0]), F.lit(r.description).alias(names[1])) for r in rules])
    return spark.range(1).select(F.inline(rows))


def quarantine_summary(quarantined: DataFrame, rules: Sequence[Rule], source: str, weight: Column, reason: str = "rejection_reason") -> DataFrame:
    """Rows and source rows by source and reason, with the registry's description."""
    counted = quarantined.groupBy(source, reason).agg(F.count("*").alias("rejected_rows"), F.sum(weight).cast("long").alias("rejected_source_rows"))
    known = registry_frame(quarantined.sparkSession, rules, (reason, "description"))
    return counted.join(F.broadcast(known), reason, "left").withColumn("description", F.coalesce("description", F.lit("unregistered rejection reason")))
