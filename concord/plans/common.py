"""Reading tables, exact sums, and the relations that several queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import namespaced_id, record_key, row_signature
from ..operators.records import merge_records
from ..operators.rules import Rule


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a table dealt over tasks by key, before work that is dear by row: a small file is read by one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def money(c: str | Column) -> Column:
    """Exact to the cent, so that sums don't depend on their order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(14,2)")


def to_double(*names: str) -> dict[str, Column]:
    return {n: F.col(n).cast("double") for n in names}


IDENTITY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]


def keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a record key (null for some), the signature of their identity columns and a source."""
    lines = table(spark, sf_dir, "lineitem")
    ident = F.when(F.col("l_suppkey") % 11 != 0, F.col("l_orderkey"))
    uid = namespaced_id(F.col("l_returnflag"), ident)
    signature = row_signature(lines, [c for c in lines.columns if c not in IDENTITY])
    return lines.withColumn("uid", uid).withColumn("record_key", record_key(uid, [F.col("l_linenumber")])).withColumn("record_signature", signature)


KEYED_SQL = """
keyed AS (
  SELECT *, l_returnflag || '-' || CASE WHEN l_suppkey % 11 <> 0 THEN l_orderkey END AS uid,
         l_returnflag || '-' || CASE WHEN l_suppkey % 11 <> 0 THEN l_orderkey END || '|' || l_linenumber AS record_key,
         md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus)) AS record_signature
  FROM lineitem)"""


def merged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    reducers = {
        "source": ("min", F.col("l_returnflag")),
        "uid": "min",
        "quantity": ("sum", F.col("l_quantity").cast("long")),
        "price": ("sum", money("l_extendedprice")),
        "discount": ("min", F.nullif(F.col("l_discount"), F.lit(0.0))),
        "is_final": ("any", F.col("l_linestatus") == "F"),
        "status": ("min", F.col("l_linestatus")),
    }
    merged = merge_records(keyed_lines(spark, sf_dir), "record_key", "record_signature", reducers)
    return merged.withColumns(to_double("price"))


MERGED_SQL = (
    KEYED_SQL
    + """,
merged AS (
  SELECT record_key, min(l_returnflag) AS source, min(uid) AS uid, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS price, min(nullif(l_discount, 0.0)) AS discount,
         bool_or(l_linestatus = 'F') AS is_final, min(l_linestatus) AS status, count(*) AS source_record_count
  FROM keyed GROUP BY record_key, CASE WHEN record_key IS NULL THEN record_signature END)"""
)

RECORD_RULES = [
    Rule("missing_id", "the record has no id", "record_key is null"),
    Rule("quantity_too_large", "more than any order can hold", "quantity > 95"),
    Rule("price_too_low", "cheaper than the cheapest part", "price < 1000"),
]
RECORD_FLAGS = [
    Rule("unit_price_off", "price for each unit out of range", "abs(price / nullif(quantity, 0) / 2000 - 1) > 0.4"),
    Rule("discount_high", "discount above the usual", "discount > 0.08"),
]


def judged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.rules import judge

    return judge(merged_lines(spark, sf_dir), RECORD_RULES, RECORD_FLAGS)


JUDGED_SQL = (
    MERGED_SQL
    + """,
judged AS (
  SELECT *, CASE WHEN record_key IS NULL THEN 'missing_id' WHEN quantity > 95 THEN 'quantity_too_large' WHEN price < 1000 THEN 'price_too_low' END AS rejection_reason,
         abs(price / nullif(quantity, 0) / 2000 - 1) > 0.4 AS unit_price_off, discount > 0.08 AS discount_high
  FROM merged)"""
)
