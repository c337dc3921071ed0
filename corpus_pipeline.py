"""A training-data pipeline over ``documents``: each stage's rows are written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import bpe, decontaminate, near_dedup, store, suffix_dedup, toxicity
from concord.llm.text import free_name
from concord.session import ship_package


def _apart(docs: DataFrame) -> DataFrame:
    """The columns an operator reads, doc_id and text, beside one struct of all others, so that no name can clash."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias(free_name(others, "_")), *[F.col(f"`{c}`") for c in others]).alias("others"))


def _together(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"others.`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on the labelled ones among them, calls toxic go.

    Null and empty texts have no features and stay unless the models' base rate is toxic; rows that
    repeat go or stay together; p_toxic at the threshold is toxic; very long texts are scored by all their
    words; an empty table stays empty, and without labels nothing goes.  Columns of any name are kept as they are.
    """
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _together(toxicity.toxicity(_apart(docs), labels).where("not toxic"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents one row stays, that with the smallest id.

    Ties (rows that share the smallest id) are broken by a hash of the text, then by the other columns; of
    rows that repeat whole one stays.  Null ids come last.  Null and empty texts link with nothing and
    all stay.  Very long texts are compared by all their shingles.  An empty table stays empty.  Columns of any
    name are kept as they are.
    """
    ship_package(spark)
    return _together(near_dedup.drop_near_duplicates(_apart(docs)), docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in strings of 200 bytes that occur elsewhere are cut out of the texts; a column n_chars follows, if there is one.

    No row goes: a text that repeats whole is left empty in each of its rows, a null text becomes empty,
    a text under 200 bytes stays, a very long one is cut like any, in pieces.  There are no ties: every occurrence is cut.  An empty table stays
    empty.  All other columns, of any name, are kept as they are.
    """
    ship_package(spark)
    out = _together(suffix_dedup.suffix_dedup(_apart(docs)), docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go.

    Null and empty texts have no words and stay; very long texts are scanned to their end; rows that repeat go or
    stay together; there are no ties.  An empty table stays empty, and without benchmark items nothing goes.  Columns of any name are kept.
    """
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _together(decontaminate.find_contamination(_apart(docs), benchmark).where("n_hit = 0"), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of the texts that are left: their number, and digests of the ids and of the decoded text.

    One row for each row, repeated or not; null and empty texts have no tokens, very long ones all of theirs;
    there are no ties; an empty table gives none.  Only doc_id of the other columns is returned, whatever their names.
    """
    ship_package(spark)
    return bpe.bpe_round_trip(docs.select("doc_id", "text"), bpe.default_vocabulary(spark))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]

#: No SQL: the stages' models, sets and byte spans are beyond it; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
