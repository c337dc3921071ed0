"""Sources: feature pages, layer metadata and range windows, all with declared schemas."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The field types of the service's own metadata.
FIELD_TYPES = {
    "esriFieldTypeOID": "bigint",
    "esriFieldTypeSmallInteger": "smallint",
    "esriFieldTypeInteger": "int",
    "esriFieldTypeBigInteger": "bigint",
    "esriFieldTypeSingle": "float",
    "esriFieldTypeDouble": "double",
    "esriFieldTypeString": "string",
    "esriFieldTypeDate": "bigint",
    "esriFieldTypeGUID": "string",
    "esriFieldTypeGlobalID": "string",
    "esriFieldTypeXML": "string",
}

METADATA = (
    "name string, geometryType string, maxRecordCount int, objectIdField string, "
    "extent struct<spatialReference:struct<wkid:int,latestWkid:int>>, editingInfo struct<lastEditDate:bigint>, "
    "fields array<struct<name:string,type:string,alias:string,domain:struct<type:string,name:string,codedValues:array<struct<code:string,name:string>>>>>"
)


def windows(spark: SparkSession, low: int, high: int, size: int) -> DataFrame:
    """Disjoint half-open ranges (start, stop) that tile low..high, each at most ``size`` wide."""
    return spark.range(low, high + 1, size).select(F.col("id").alias("start"), F.least(F.col("id") + size, F.lit(high + 1)).alias("stop"))


def bounds(df: DataFrame, key: str, where: str | None = None) -> DataFrame:
    """One row: count, low and high of the key, under the predicate of the scan."""
    return (df.where(where) if where else df).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))


def scan_windows(df: DataFrame, key: str, window_frame: DataFrame, where: str | None = None) -> DataFrame:
    """The rows that fall in some window, with its start; an equi-join on the window's number, not a range join."""
    size = window_frame.agg(F.max(F.col("stop") - F.col("start")).alias("size"), F.min("start").alias("low"))
    rows = (df.where(where) if where else df).crossJoin(F.broadcast(size))  # one row
    rows = rows.withColumn("start", F.col("low") + F.floor((F.col(key) - F.col("low")) / F.col("size")) * F.col("size")).drop("size", "low")
    return rows.join(window_frame, "start").where((F.col(key) >= F.col("start")) & (F.col(key) < F.col("stop"))).drop("stop")


def equal_windows(df: DataFrame, key: str, n: int, where: str | None = None) -> DataFrame:
    """Half-open ranges (start, stop), at most ``n``, that tile the keys and hold about equally many rows each, however the keys lie.

    The borders are quantiles from a mergeable sketch, a hundredth of a window off at most; one row of n numbers comes to the
    driver.  A key on many rows stays in one window.
    """
    rows = df.where(where) if where else df
    shares = [i / n for i in range(1, n)]
    got = rows.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.percentile_approx(key, shares or [0.5], 100 * n).alias("q")).first()
    if got["low"] is None:
        return df.sparkSession.createDataFrame([], "start long, stop long")
    starts = sorted({got["low"], *(q + 1 for q in got["q"] if shares and q < got["high"])})
    return df.sparkSession.createDataFrame(list(zip(starts, [*starts[1:], got["high"] + 1])), "start long, stop long")


def window_start(key: Column, starts: Sequence[int]) -> Column:
    """The start of the window that a key is in (starts ascending), null before the first: two short searches, no join."""
    size = max(1, math.isqrt(len(starts)))
    groups = [list(starts[i : i + size]) for i in range(0, len(starts), size)]
    upto = lambda values: F.size(F.filter(values, lambda s: s <= key))
    group = F.get(F.lit(groups), upto(F.lit([g[0] for g in groups])) - 1)
    return F.get(group, upto(group) - 1)


def read_jdbc_windows(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, size: int, most: int = 64, **options: str) -> DataFrame:
    """A table over JDBC, one partition and connection for each key window; filters and columns are pushed to the source.

    There are at most ``most`` windows, so that no more connections than that are open; windows get wider instead.
    """
    return spark.read.format("jdbc").options(**jdbc_windows(key, low, high, size, most), url=url, dbtable=table, **options).load()


def jdbc_windows(key: str, low: int, high: int, size: int, most: int) -> dict[str, str]:
    n = min(most, max(1, -(-(high + 1 - low) // size)))
    return {"partitionColumn": key, "lowerBound": str(low), "upperBound": str(high + 1), "numPartitions": str(n)}


def safe_names(names: Sequence[str], geometry: str | None = None) -> list[str]:
    """Lower-cased names, the geometry column as ``geom``; an unsafe name or a collision is an error."""
    out = ["geom" if geometry and n.lower() == geometry.lower() else n.lower() for n in names]
    unsafe = [n for n in out if not re.fullmatch(r"[a-z_][a-z0-9_]{0,62}", n)]
    twice = sorted({n for n in out if out.count(n) > 1})
    if unsafe or twice:
        raise ValueError(f"unsafe names {unsafe}, colliding names {twice}")
    return out


def declared_schema(fields: Sequence[tuple[str, str]]) -> T.StructType:
    """A schema from (name, published type); an unknown type is text."""
    names = safe_names([n for n, _ in fields])
    return T.StructType([T.StructField(n, T._parse_datatype_string(FIELD_TYPES.get(t, "string"))) for n, (_, t) in zip(names, fields)])


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in order: undeclared ones go, absent ones are null, values that don't fit are null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(f"`{have[f.name]}`").try_cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_features(spark: SparkSession, path: str, properties: T.StructType, key: str = "properties", geometry: bool = True) -> DataFrame:
    """Feature pages (one JSON object a file): a row for each feature, its properties as columns.

    ``key``: ``properties`` for GeoJSON, ``attributes`` for tables without geometry.
    """
    feature = T.StructType([T.StructField(key, properties)])
    if geometry:
        feature.add("geometry", T._parse_datatype_string("struct<type:string,coordinates:string>"))
    pages = spark.read.schema(T.StructType([T.StructField("features", T.ArrayType(feature))])).json(path, multiLine=True)
    rows = pages.select(F.explode("features").alias("f"))
    return rows.select(f"f.{key}.*", *([parse_coordinates("f.geometry").alias("geom")] if geometry else []))


def parse_coordinates(geometry: str):
    """GeoJSON Polygon or MultiPolygon coordinates (as JSON text) to parts -> rings -> points."""
    text = F.col(f"{geometry}.coordinates")
    many = F.from_json(text, "array<array<array<array<double>>>>")
    one = F.array(F.from_json(text, "array<array<array<double>>>"))
    to_points = lambda parts: F.transform(parts, lambda rings: F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))))
    return F.when(F.col(f"{geometry}.type") == "MultiPolygon", to_points(many)).when(F.col(f"{geometry}.type") == "Polygon", to_points(one))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Layer descriptions, one JSON object a file."""
    return spark.read.schema(METADATA).json(path, multiLine=True).withColumn("layer", F.input_file_name())


def field_snapshot(metadata: DataFrame, run: str) -> DataFrame:
    """One row for each field of each layer, stamped with the run."""
    f = metadata.select("*", F.explode("fields").alias("f"))
    crs = F.coalesce("extent.spatialReference.latestWkid", "extent.spatialReference.wkid")
    return f.select("layer", F.col("name").alias("layer_name"), F.col("f.name").alias("field_name"), F.col("f.type").alias("field_type"), crs.alias("crs"), F.col("maxRecordCount").alias("max_record_count"), F.timestamp_millis("editingInfo.lastEditDate").alias("source_last_edit_at"), F.lit(run).cast("timestamp").alias("captured_at"))


def coded_values(metadata: DataFrame, run: str) -> DataFrame:
    """One row for each code of each field with a coded-value domain."""
    f = metadata.select("layer", F.explode("fields").alias("f")).where("f.domain.codedValues is not null")
    c = f.select("layer", "f", F.explode("f.domain.codedValues").alias("c"))
    return c.select("layer", F.col("f.name").alias("field_name"), F.col("f.domain.name").alias("domain_name"), F.col("c.code").alias("code"), F.col("c.name").alias("label"), F.lit(run).cast("timestamp").alias("captured_at"))


def crs_violations(metadata: DataFrame, declared: Mapping[str, int]) -> DataFrame:
    """Layers whose published CRS isn't the declared one; an unpublished CRS (0 or null) passes."""
    known = F.create_map(*[x for k, v in declared.items() for x in (F.lit(k), F.lit(v))])
    crs = F.coalesce("extent.spatialReference.latestWkid", "extent.spatialReference.wkid", F.lit(0))
    return metadata.select("name", crs.alias("observed"), known[F.col("name")].alias("declared")).where("observed <> 0 and not coalesce(observed = declared, false)")


def read_seed(spark: SparkSession, path: str, schema: str = "code string, label string, note string") -> DataFrame:
    """A seed CSV with declared types (codes stay text)."""
    return spark.read.schema(schema).csv(path, header=True)
