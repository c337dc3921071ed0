"""Feature pages as a Spark data source: a folder of pages, each a window of the key, read by windows.

A folder has ``layer.json`` (the layer's published description), ``pages/`` (one JSON object a page: features with
their ``properties`` or ``attributes``) and ``manifest/`` (JSON lines: page, low, high and n of each).  The reader
makes a partition for each window.  Filters that Spark pushes on the key choose the windows before any page is
opened; they stay with Spark as well, which decides row by row.

Files are opened in the tasks, through the file systems of pyarrow (local, HDFS, object stores), never by the driver but
for the description and the manifest.  The writer makes a file for each page, and each task lists its own pages in a part of
the manifest, so that nothing is listed or read again for it.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.geometry import GEOMETRY, to_geojson
from .pages import FIELD_TYPES, safe_names

FORMAT = "feature_pages"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _read(path: str) -> str:
    system, at = _open(path)
    with system.open_input_stream(at) as f:
        return f.read().decode()


def _lines(folder: str) -> list[str]:
    system, at = _open(folder)
    out = []
    for f in system.get_file_info(fs.FileSelector(at)):
        if f.is_file and not f.base_name.startswith(("_", ".")):
            with system.open_input_stream(f.path) as stream:
                out += stream.read().decode().splitlines()
    return out


@dataclass
class Window(InputPartition):
    """One page, and the keys that it has."""

    page: str
    low: int
    high: int


class FeaturePages(DataSource):
    """Options: ``path``, ``key`` (default: the layer's id field); for writing ``path`` and ``window``, the name that the pages' folders have."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def layer(self) -> dict:
        return json.loads(_read(f"{self.options['path']}/layer.json"))

    def schema(self) -> str:
        layer = self.layer()
        names = safe_names([f["name"] for f in layer["fields"]])
        columns = [f"`{n}` {FIELD_TYPES.get(f['type'], 'string')}" for n, f in zip(names, layer["fields"])]
        return ", ".join([*columns, *([f"geom {GEOMETRY}"] if layer.get("geometryType") else []), "page string"])

    def reader(self, schema: T.StructType) -> FeatureReader:
        return FeatureReader(self.options["path"], (self.options.get("key") or self.layer()["objectIdField"]).lower(), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> PageWriter:
        system, at = _open(f"{self.options['path']}/pages")
        if system.get_file_info(at).type != fs.FileType.NotFound:
            raise FileExistsError(at)
        return PageWriter(self.options["path"], self.options["window"])


class FeatureReader(DataSourceReader):
    def __init__(self, path: str, key: str, schema: T.StructType):
        self.path, self.key, self.fields = path, key, schema
        self.low, self.high = -math.inf, math.inf

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == (self.key,):
                low, high = _range(f)
                self.low, self.high = max(self.low, low), min(self.high, high)
            yield f

    def partitions(self) -> list[Window]:
        rows = [{"low": -math.inf, "high": math.inf} | json.loads(line) for line in _lines(f"{self.path}/manifest")]  # a page without keys has neither
        return [Window(r["page"], r["low"], r["high"]) for r in sorted(rows, key=lambda r: (r["low"], r["page"])) if r["high"] >= self.low and r["low"] <= self.high] or [Window("", 0, -1)]

    def read(self, window: Window) -> Iterator[pa.RecordBatch]:
        if not window.page:  # no window is wanted, but Spark wants a partition
            return
        features = json.loads(_read(window.page)).get("features") or []
        rows = [{k.lower(): v for k, v in (f.get("properties") or f.get("attributes") or {}).items()} for f in features]
        schema = to_arrow_schema(self.fields)
        columns = []
        for f in schema:
            if f.name == "page":
                values = [window.page] * len(rows)
            elif f.name == "geom" and pa.types.is_list(f.type):
                values = [_parts(x.get("geometry")) for x in features]
            else:
                values = [_fit(r.get(f.name.lower()), f.type) for r in rows]
            columns.append(pa.array(values, f.type))
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


@dataclass
class Written(WriterCommitMessage):
    """How many pages a task wrote."""

    n: int


class PageWriter(DataSourceArrowWriter):
    """Rows (at: the window as text, held: JSON of low, high and n, value: the page's text) as files, one for each.

    A file gets its name when it is whole, so a stream never sees part of a page; a task that is run again makes the same files.
    """

    def __init__(self, path: str, window: str):
        self.path, self.window = path, window

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _open(self.path)
        task, lines, seen = TaskContext.get().partitionId(), [], Counter()
        for batch in iterator:
            for at, held, value in zip(*(batch.column(c) for c in ("at", "held", "value"))):
                folder = f"pages/{self.window}={_folder(at.as_py())}"
                name = f"part-{task}-{seen[folder]}.json"  # several windows may have one name: null and empty text
                seen[folder] += 1
                _write_whole(system, f"{root}/{folder}", name, f"{value.as_py()}\n")
                lines.append(json.dumps({"page": f"{self.path}/{quote(folder, safe='/=')}/{name}"} | json.loads(held.as_py())))
        if lines:
            _write_whole(system, f"{root}/manifest", f"part-{task}.json", "\n".join(lines))
        return Written(len(lines))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self._folders(lambda system, at: system.create_dir(at))  # a table without rows has no pages, but the folders

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._folders(lambda system, at: system.delete_dir(at) if system.get_file_info(at).type != fs.FileType.NotFound else None)

    def _folders(self, do) -> None:
        for name in ("pages", "manifest"):
            do(*_open(f"{self.path}/{name}"))


def _folder(value: str | None) -> str:
    """A value as Spark names the folder of a partition."""
    return re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda c: f"%{ord(c[0]):02X}", value) if value else "__HIVE_DEFAULT_PARTITION__"


def _write_whole(system: fs.FileSystem, folder: str, name: str, text: str) -> None:
    """The file under a hidden name first; one of an earlier attempt at the task gives way."""
    system.create_dir(folder)
    part = f"{folder}/.{name}.{TaskContext.get().taskAttemptId()}"
    with system.open_output_stream(part) as f:
        f.write(text.encode())
    if system.get_file_info(f"{folder}/{name}").type != fs.FileType.NotFound:
        system.delete_file(f"{folder}/{name}")
    system.move(part, f"{folder}/{name}")


def _range(f: Filter) -> tuple[float, float]:
    """The whole numbers that a filter on the key lets through, from the least to the largest."""
    low, high = -math.inf, math.inf
    if isinstance(f, In):
        known = [v for v in f.value if v is not None]
        return min(known, default=math.inf), max(known, default=-math.inf)
    if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
        low = f.value + 1 if isinstance(f, GreaterThan) else f.value
    if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
        high = f.value - 1 if isinstance(f, LessThan) else f.value
    return low, high


def _fit(value, kind: pa.DataType):
    """The value as the declared type; null if it doesn't fit."""
    try:
        if value is None:
            return None
        if pa.types.is_string(kind):
            return value if isinstance(value, str) else json.dumps(value)
        if pa.types.is_floating(kind):
            return float(value)
        number = int(value)
        return number if number == float(value) and -(1 << kind.bit_width - 1) <= number < 1 << kind.bit_width - 1 else None
    except (ValueError, TypeError, OverflowError):
        return None


def _parts(geometry: dict | None) -> list | None:
    """A GeoJSON Polygon or MultiPolygon as parts, rings, points."""
    kind, coordinates = (geometry or {}).get("type"), (geometry or {}).get("coordinates")
    if not coordinates or kind not in ("Polygon", "MultiPolygon"):
        return None
    return [[[{"x": float(p[0]), "y": float(p[1])} for p in ring] for ring in part] for part in (coordinates if kind == "MultiPolygon" else [coordinates])]


def read_pages(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """The features of a folder, with the page that each is from.  Filters on the key choose pages; pages not chosen aren't opened."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FeaturePages)
    reader = spark.read.format(FORMAT).option("path", path)
    return (reader.option("key", key) if key else reader).load()


def write_pages(df: DataFrame, path: str, layer: dict, key: str, window: str = "window", geom: str | None = None, properties: str = "properties") -> None:
    """Rows as pages, one for each value of ``window``, with the manifest and the layer's description.

    A page is one line of JSON put together by a group of the window's rows, so a window should be of bounded size (see
    pages.equal_windows).  Windows are dealt over all tasks, since a page is dear by its file and not by its bytes.
    """
    spark = df.sparkSession
    fields = [c for c in df.columns if c not in (window, geom)]
    feature = [F.struct(*[F.col(c).alias(c.upper()) for c in fields]).alias(properties)]
    if geom:
        feature.append(F.from_json(to_geojson(F.col(geom)), "struct<type:string,coordinates:array<array<array<array<double>>>>>").alias("geometry"))
    dealt = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), window)
    held = F.struct(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n"))
    rows = dealt.groupBy(window).agg(F.sort_array(F.collect_list(F.struct(F.col(key).alias("at"), F.struct(*feature).alias("f")))).alias("rows"), held.alias("held"))
    text = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.transform("rows", lambda r: r["f"]).alias("features")))
    spark.dataSource.register(FeaturePages)
    pages = rows.select(F.col(window).cast("string").alias("at"), F.to_json("held").alias("held"), text.alias("value"))
    pages.write.format(FORMAT).mode("append").option("path", path).option("window", window).save()
    _put(spark, f"{path}/layer.json", json.dumps(layer))


def _put(spark: SparkSession, path: str, text: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
