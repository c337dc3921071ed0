"""Sinks: loads that are validated before they are published, history, exports."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import GEOMETRY, to_geojson, to_wkb


@dataclass(frozen=True)
class LoadReport:
    rows: int
    distinct_keys: int | None
    null_keys: int | None
    problems: tuple[str, ...]

    @property
    def ok(self) -> bool:
        return not self.problems


class ContractError(RuntimeError):
    pass


def load_figures(df: DataFrame, key: str | None) -> DataFrame:
    """One row of the figures that a load is judged by."""
    columns = [F.count("*").alias("rows")]
    if key and key in df.columns:
        columns += [F.countDistinct(key).alias("distinct_keys"), F.count_if(F.col(key).isNull()).alias("null_keys")]
    return df.agg(*columns)


def check_load(df: DataFrame, key: str | None = None, expected: int | None = None) -> LoadReport:
    """Not empty, as many rows as expected, keys present and unique; a table without the key is only counted."""
    return _report(load_figures(df, key).first().asDict(), expected)


def _report(r: dict, expected: int | None) -> LoadReport:
    problems = []
    if r["rows"] == 0:
        problems.append("empty")
    if expected is not None and r["rows"] != expected:
        problems.append(f"{r['rows']} rows, {expected} expected")
    if "distinct_keys" in r:
        if r["null_keys"]:
            problems.append(f"{r['null_keys']} null keys")
        if r["distinct_keys"] + r["null_keys"] != r["rows"]:
            problems.append(f"{r['rows'] - r['null_keys'] - r['distinct_keys']} repeated keys")
    return LoadReport(r["rows"], r.get("distinct_keys"), r.get("null_keys"), tuple(problems))


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def contracted_load(df: DataFrame, root: str, table: str, version: str, key: str | None = None, expected: int | None = None) -> LoadReport:
    """Writes a version, validates it, and only then points the table at it.

    Rows and missing keys are counted while they are written, so the input is read once; what is read back is the key's column
    alone, whose distinct values a partial aggregate counts.

    The pointer is a file that is written beside the old one and renamed over it in one step, so that the table
    always has a whole version.  On failure, or if the version is there already, the staged files go, the
    table stays as it was, and ContractError is raised.
    """
    spark = df.sparkSession
    staged, final = f"{root}/{table}/__loading_{version}_{uuid.uuid4().hex}", f"{root}/{table}/version={version}"
    keyed = bool(key) and key in df.columns
    seen, figures = Observation(), [F.count(F.lit(1)).alias("rows")]
    if keyed:
        figures.append(F.count_if(F.col(key).isNull()).alias("null_keys"))
    df.observe(seen, *figures).write.mode("overwrite").parquet(staged)
    counted = dict(seen.get)
    if keyed:
        counted["distinct_keys"] = spark.read.parquet(staged).agg(F.countDistinct(key)).first()[0]
    report = _report(counted, expected)
    fs, staged_path = _fs(spark, staged)
    if not report.ok:
        fs.delete(staged_path, True)
        raise ContractError(f"{table}: {', '.join(report.problems)}")
    final_path = _fs(spark, final)[1]
    # An existing folder would take the staged one in as a child.
    if fs.exists(final_path) or not fs.rename(staged_path, final_path):
        fs.delete(staged_path, True)
        raise ContractError(f"{table}: version {version} is there already")
    _point(spark, f"{root}/{table}", version)
    return report


def _point(spark: SparkSession, folder: str, version: str) -> None:
    """Renames a new pointer over the old one."""
    fs, new = _fs(spark, f"{folder}/__pointer_{uuid.uuid4().hex}")
    out = fs.create(new, True)
    try:
        out.write(bytearray(json.dumps({"version": version}).encode()))
    finally:
        out.close()
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(new), fs.makeQualified(_fs(spark, f"{folder}/current.json")[1]), options)


def current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The version that the table points at."""
    version = spark.read.schema("version string").json(f"{root}/{table}/current.json").first()["version"]
    return spark.read.parquet(f"{root}/{table}/version={version}")


def materialise(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """A layer kept as a table: written under ``root`` (or a scratch folder that goes with the session), named, and read again."""
    spark = df.sparkSession
    path = f"{root}/{name}" if root else scratch_folder(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.createOrReplaceTempView(name)
    return out


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A layer kept as a view: named, computed again by each reader."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def append_history(df: DataFrame, path: str, run: str = "captured_at") -> None:
    """Appends a run to a history that is only ever added to, partitioned by the run."""
    df.write.mode("append").partitionBy(run).parquet(path)


def publish_changed(df: DataFrame, decisions: DataFrame, path: str, source: str) -> list[str]:
    """Recomputes and replaces the partitions of changed sources; the files of the others stay as they are.

    ``decisions``: of vintage.freshness, one row a source (there are as many as the manifest names).  The names of what
    was replaced are returned.  A changed source without rows keeps what it has, as a load that is empty would.
    """
    changed = sorted(r[0] for r in decisions.where("changed").select(source).distinct().collect())
    if changed:
        rows = df.where(F.col(source).isin(changed))  # reaches the scan, so the others aren't read
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(source).parquet(path)
    return changed


def curve_place(x: Column, y: Column, extent: tuple[float, float, float, float], bits: int = 16) -> Column:
    """Place of a point on a Z-shaped curve over the extent (x0, y0, x1, y1): its coordinates' bits in turn."""

    def spread(v: Column, low: float, high: float) -> Column:
        cells = (1 << bits) - 1
        at = F.least(F.greatest(F.floor((v - low) / ((high - low) or 1.0) * cells), F.lit(0)), F.lit(cells)).cast("long")
        for step, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            at = at.bitwiseOR(F.shiftleft(at, step)).bitwiseAND(F.lit(mask))
        return at

    return spread(x, extent[0], extent[2]).bitwiseOR(F.shiftleft(spread(y, extent[1], extent[3]), 1))


def store_clustered(df: DataFrame, path: str, box: str = "box", files: int | None = None, group_bytes: int = 8 << 20) -> None:
    """Features in the order of a curve through their boxes' middles, the box as columns x0, y0, x1, y1 of their own.

    Neighbours lie in the same row groups, so the statistics of the four columns let a lookup by place pass over nearly all others.
    """
    corners = [F.col(f"{box}.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")]
    rows = df.select(*[c for c in df.columns if c != box], *corners)
    middle = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    e = rows.agg(*[f(m) for f in (F.min, F.max) for m in middle]).first()
    extent = (e[0], e[1], e[2], e[3]) if e[0] is not None else (0.0, 0.0, 1.0, 1.0)
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_place", curve_place(*middle, extent)).repartitionByRange(files, "_place").sortWithinPartitions("_place").drop("_place")
    rows.write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)


def near_point(spark: SparkSession, path: str, x: float, y: float) -> DataFrame:
    """Features of store_clustered() whose box holds the point, the box put together again; the four comparisons are pushed to the scan."""
    rows = spark.read.parquet(path).where((F.col("x0") <= x) & (F.col("x1") >= x) & (F.col("y0") <= y) & (F.col("y1") >= y))
    corners = ("x0", "y0", "x1", "y1")
    return rows.withColumn("box", F.struct(*corners)).drop(*corners)


def is_geometry(field: T.StructField) -> bool:
    return field.dataType.simpleString() == GEOMETRY or field.name.lower() in ("geom", "geometry")


def without_geometry(df: DataFrame) -> DataFrame:
    """Columns that aren't geometry, by type and by name."""
    return df.select(*[f.name for f in df.schema.fields if not is_geometry(f)])


def feature_columns(df: DataFrame, geom: str = "geom", form: str = "geojson") -> DataFrame:
    """All columns but the geometry, which comes last as GeoJSON text or as well-known binary (``form="wkb"``)."""
    last = to_wkb(F.col(geom)).alias(f"{geom}_wkb") if form == "wkb" else to_geojson(F.col(geom)).alias(f"{geom}_json")
    return df.select(*[c for c in df.columns if c != geom], last)


def json_array(df: DataFrame) -> DataFrame:
    """A small table as one row of text, a JSON array of objects ordered by their text; nulls are written."""
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row"))
    return rows.agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("row")), ","), F.lit("]")).alias("value"))


def export(tables: Mapping[str, DataFrame], root: str, small: tuple[str, ...] = (), features: Mapping[str, str] | None = None) -> None:
    """One snapshot: every table as zstd Parquet and CSV, the small ones as JSON (lines, and one array), features as Parquet with GeoJSON and WKB.

    It replaces the one before: outputs that this one doesn't have are deleted.
    """
    spark = next(iter(tables.values())).sparkSession
    wanted = {"parquet": tables, "csv": tables, "json": small, "json_array": small, "features": features or {}, "features_wkb": features or {}}
    for form, names in wanted.items():
        fs, folder = _fs(spark, f"{root}/{form}")
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            if status.getPath().getName() not in names:
                fs.delete(status.getPath(), True)
    for name, df in tables.items():
        plain = without_geometry(df)
        plain.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/parquet/{name}")
        plain.write.mode("overwrite").csv(f"{root}/csv/{name}", header=True)
        if name in small:
            plain.write.mode("overwrite").json(f"{root}/json/{name}")
            json_array(plain).write.mode("overwrite").text(f"{root}/json_array/{name}")
    for name, geom in (features or {}).items():
        for form, folder in (("geojson", "features"), ("wkb", "features_wkb")):
            feature_columns(tables[name], geom, form).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{folder}/{name}")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in ``spark.checkpoint.dir``, which the cluster shares; a temporary one only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = base or tempfile.mkdtemp(prefix="concord-")
    path = f"{base.rstrip('/')}/concord-{name}-{uuid.uuid4().hex}"
    fs, p = _fs(spark, path)
    fs.deleteOnExit(p)
    return path
