"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where a local session has none, as in tests, a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not folder:
        folder = getattr(shared_folder, "own", None) or tempfile.mkdtemp(prefix="concord-")
        shared_folder.own = folder
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives lost executors.

    The table is deleted by discard(), or else when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/concord-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._concord_path = where
    return out


def discard(*tables: DataFrame | None) -> None:
    """Deletes stored tables that nothing still to be computed reads."""
    for t in tables:
        where = getattr(t, "_concord_path", None)
        if where is not None:
            where.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
