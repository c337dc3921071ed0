"""New page files are landed as they come, each file once, by Structured Streaming.

The engine has no other streaming surface: everything behind the landing is a batch over versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


# Tasks that list files, for each core; Spark's own number, one for each folder or file up to 10,000, costs more than what they do.
_LISTING, _TASKS_A_CORE = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4


def _list_in_few_tasks(spark: SparkSession) -> None:
    """For the session, as a stream lists anew for each of its batches; a number that the session has set otherwise stays."""
    if spark.conf.get(_LISTING) == "10000":
        spark.conf.set(_LISTING, str(_TASKS_A_CORE * spark.sparkContext.defaultParallelism))


def page_stream(spark: SparkSession, path: str, properties: T.StructType, key: str = "properties", files_a_batch: int = 1000) -> DataFrame:
    """Features of page files as a stream, with the file each is from."""
    _list_in_few_tasks(spark)
    feature = T.StructType([T.StructField(key, properties)])
    schema = T.StructType([T.StructField("features", T.ArrayType(feature))])
    pages = spark.readStream.schema(schema).option("multiLine", True).option("maxFilesPerTrigger", files_a_batch).json(path)
    return pages.select(F.explode("features").alias("f"), F.col("_metadata.file_path").alias("page")).select(f"f.{key}.*", "page")


def land_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends all pages that are there now to ``target`` and ends; a later call takes up the new ones only."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start(target)
