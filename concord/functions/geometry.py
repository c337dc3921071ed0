"""Polygons as nested arrays: parts -> rings -> points struct<x:double,y:double>, without a geometry kernel.

Rings are closed (first point = last point); the first ring of a part is its shell.  What looks at single
points is one Catalyst expression; what compares edges with edges (validity, overlaps, unions) is an
Arrow function in numpy over whole batches, in ``shapes``; repair and outlines walk the faces of a graph, in ``planar``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import planar, shapes

POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"
GEOMETRY = f"array<array<{RING}>>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def polygon(points: list[tuple[Column, Column]]) -> Column:
    """One part with one ring through the points, closed."""
    ring = F.array(*[point(x, y) for x, y in [*points, points[0]]])
    return F.array(F.array(ring))


def multi(rings: Column) -> Column:
    """A single polygon, its rings, as a geometry of one part; null and empty ones as they are."""
    return F.when(rings.isNotNull(), F.when(F.size(rings) > 0, F.array(rings)).otherwise(F.array().cast(GEOMETRY)))


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return polygon([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


def with_srid(geom: Column, srid: Column | int) -> Column:
    """A geometry with the number of its reference system (0: not known), as a struct; null stays null."""
    return F.when(geom.isNotNull(), F.struct((F.lit(srid) if isinstance(srid, int) else srid).cast("int").alias("srid"), geom.alias("shape")))


def srid(tagged: Column) -> Column:
    return tagged.srid


def shape(tagged: Column) -> Column:
    """The geometry of with_srid()."""
    return tagged.shape


def srid_fits(tagged: Column, declared: Column | int) -> Column:
    """Whether a geometry is in the declared reference system, or states none."""
    return (tagged.srid == 0) | (tagged.srid == declared)


def transformed(tagged: Column, target: int, sources: tuple[int, ...]) -> Column:
    """A geometry in the target system, whichever of the sources it is in; null if it is in none of them."""
    cases = [F.when(tagged.srid == s, with_srid(reproject(tagged.shape, s, target), target)) for s in sources]
    return F.coalesce(*cases)


def points(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def is_empty(geom: Column) -> Column:
    return F.size(points(geom)) == 0


def bbox(geom: Column) -> Column:
    p = points(geom)
    xs, ys = F.transform(p, lambda q: q.x), F.transform(p, lambda q: q.y)
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def boxes_meet(a: Column, b: Column) -> Column:
    """Boxes that share more than a border."""
    return (a.x0 < b.x1) & (b.x0 < a.x1) & (a.y0 < b.y1) & (b.y0 < a.y1)


def ring_edges(ring: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.size(ring) - 1),
        lambda i: F.struct(F.get(ring, i - 1).x.alias("x1"), F.get(ring, i - 1).y.alias("y1"), F.get(ring, i).x.alias("x2"), F.get(ring, i).y.alias("y2")),
    )


def edges(geom: Column) -> Column:
    """All directed edges of all rings."""
    return F.flatten(F.transform(F.filter(F.flatten(geom), lambda r: F.size(r) > 1), ring_edges))


def signed_area(ring: Column) -> Column:
    """Positive if the ring runs counter-clockwise; measured from its first point, against cancellation."""
    x0, y0 = F.get(ring, F.lit(0)).x, F.get(ring, F.lit(0)).y
    cross = lambda e: (e.x1 - x0) * (e.y2 - y0) - (e.x2 - x0) * (e.y1 - y0)
    return F.when(F.size(ring) > 2, F.aggregate(ring_edges(ring), F.lit(0.0), lambda s, e: s + cross(e)) / 2).otherwise(0.0)


def area(geom: Column) -> Column:
    """Shells less holes (the first ring of a part is its shell)."""
    part = lambda rings: F.aggregate(rings, F.lit(0.0), lambda s, r: s - F.abs(signed_area(r))) + 2 * F.abs(signed_area(F.get(rings, F.lit(0))))
    return F.aggregate(F.filter(geom, lambda rings: F.size(rings) > 0), F.lit(0.0), lambda s, rings: s + part(rings))


def fills(geom: Column, box: Column) -> Column:
    """Whether a geometry is all of its box: one ring of four corners around no less than the box; false where that isn't known."""
    rings = F.get(geom, F.lit(0))
    ring = F.get(rings, F.lit(0))
    around = F.abs(signed_area(ring))
    whole = (around == (box.x1 - box.x0) * (box.y1 - box.y0)) & (around > 0) & (around < float("inf"))
    return F.coalesce((F.size(geom) == 1) & (F.size(rings) == 1) & (F.size(ring) == 5) & (F.get(ring, F.lit(0)) == F.get(ring, F.lit(4))) & whole, F.lit(False))


def overlap_area(a: Column, b: Column) -> Column:
    """Area common to two geometries of simple rings."""
    return F.arrow_udf(lambda g, h: pa.array(shapes.overlap_areas(g, h)), "double")(a, b)


def union_area(geom: Column) -> Column:
    """Area that the parts of a geometry cover, what they share counted once; null for a null geometry."""
    return F.arrow_udf(lambda g: pa.array(planar.covered_areas(g), pa.float64()), "double")(geom)


def contains(geom: Column, x: Column, y: Column) -> Column:
    """Even-odd rule; a point on the lower or left border is inside."""
    hits = lambda e: ((e.y1 <= y) != (e.y2 <= y)) & (x < e.x1 + (y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1))
    return F.size(F.filter(edges(geom), hits)) % 2 == 1


def is_valid(geom: Column) -> Column:
    """Whether a geometry is valid in the sense of simple features: null for a null one, false for an empty one.

    Rings are closed, finite and simple (no edge meets another but at the vertex they share, no spike) and have
    an area; holes lie inside their shell and not in each other, parts lie outside each other; rings may
    touch in points, unless that cuts the inside of a part in two.
    """
    return F.arrow_udf(lambda g: pa.array(shapes.valid(g), pa.bool_()), "boolean")(geom)


def to_geojson(geom: Column) -> Column:
    """GeoJSON MultiPolygon text."""
    coords = F.transform(geom, lambda rings: F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p.x, p.y))))
    return F.when(geom.isNotNull(), F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), coords.alias("coordinates"))))


def to_wkb(geom: Column) -> Column:
    """Well-known binary of a MultiPolygon, little-endian; null for a null geometry."""
    return F.arrow_udf(lambda g: pa.array(shapes.wkb(g), pa.binary()), "binary")(geom)


# Fixed value: radius in metres of the sphere of web Mercator.
_SPHERE = 6378137.0


def mercator_to_lonlat(p: Column) -> Column:
    return point(F.degrees(p.x / _SPHERE), F.degrees(2 * F.atan(F.exp(p.y / _SPHERE)) - math.pi / 2))


def lonlat_to_mercator(p: Column) -> Column:
    return point(F.radians(p.x) * _SPHERE, F.log(F.tan(math.pi / 4 + F.radians(p.y) / 2)) * _SPHERE)


@dataclass(frozen=True)
class Conic:
    """A Lambert conformal conic projection with two standard parallels on an ellipsoid (degrees, units)."""

    lat0: float
    lon0: float
    lat1: float
    lat2: float
    easting: float
    northing: float
    unit: float = 1.0
    a: float = 6378137.0
    f: float = 1 / 298.257222101

    @property
    def e(self) -> float:
        return math.sqrt(2 * self.f - self.f * self.f)

    def _t(self, lat: float) -> float:
        s = self.e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (self.e / 2)

    def constants(self) -> tuple[float, float, float]:
        lat0, lat1, lat2 = map(math.radians, (self.lat0, self.lat1, self.lat2))
        m = lambda x: math.cos(x) / math.sqrt(1 - (self.e * math.sin(x)) ** 2)
        n = (math.log(m(lat1)) - math.log(m(lat2))) / (math.log(self._t(lat1)) - math.log(self._t(lat2)))
        big = m(lat1) / (n * self._t(lat1) ** n)
        return n, big, self.a * big * self._t(lat0) ** n

    def forward(self, p: Column) -> Column:
        n, big, rho0 = self.constants()
        lat = F.radians(p.y)
        s = F.sin(lat) * self.e
        t = F.tan(math.pi / 4 - lat / 2) / F.pow((1 - s) / (1 + s), F.lit(self.e / 2))
        rho, theta = F.pow(t, F.lit(n)) * (self.a * big), F.radians(p.x - self.lon0) * n
        return point((rho * F.sin(theta)) / self.unit + self.easting, (rho0 - rho * F.cos(theta)) / self.unit + self.northing)

    def inverse(self, p: Column, rounds: int = 5) -> Column:
        """Longitude and latitude, the latter by a fixed number of iterations."""
        n, big, rho0 = self.constants()
        x, y = (p.x - self.easting) * self.unit, rho0 - (p.y - self.northing) * self.unit
        rho, theta = F.sqrt(x * x + y * y), F.atan2(x, y)
        t = F.pow(rho / (self.a * big), F.lit(1 / n))
        step = F.struct(t.alias("t"), (math.pi / 2 - 2 * F.atan(t)).alias("lat"))

        def once(s: Column, _: Column) -> Column:
            q = F.sin(s.lat) * self.e
            return F.struct(s.t.alias("t"), (math.pi / 2 - 2 * F.atan(s.t * F.pow((1 - q) / (1 + q), F.lit(self.e / 2)))).alias("lat"))

        lat = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), step, once).lat
        return point(F.degrees(theta / n) + self.lon0, F.degrees(lat))


# Two state plane zones of the US (NAD83 HARN), in US survey feet.
_FOOT = 1200 / 3937
CONICS = {
    2926: Conic(47.0, -120.0 - 50 / 60, 47.5, 48.0 + 44 / 60, 500000 / _FOOT, 0.0, _FOOT),
    2927: Conic(45.0 + 20 / 60, -120.5, 45.0 + 50 / 60, 47.0 + 20 / 60, 500000 / _FOOT, 0.0, _FOOT),
}


def reproject(geom: Column, source: int, target: int) -> Column:
    """Every point from one CRS (4326, 3857 or one of CONICS) to another; shifts between datums are ignored."""
    if source == target:
        return geom
    into = (lambda p: p) if source == 4326 else mercator_to_lonlat if source == 3857 else lambda p: CONICS[source].inverse(p)
    out = (lambda p: p) if target == 4326 else lonlat_to_mercator if target == 3857 else CONICS[target].forward
    return F.transform(geom, lambda rings: F.transform(rings, lambda r: F.transform(F.transform(r, into), out)))


# --- Repair, dissolved outlines and simplification: Arrow functions.


def repaired_geometries(geoms: pa.Array) -> pa.Array:
    """What the rings of each geometry go round, as valid polygons (see planar.repaired); null if that is nothing."""
    return planar.geometries(planar.repaired(planar.arrays(geoms)), geoms.type)


def repair(df: DataFrame, geom: str = "geom", valid: str | None = None) -> DataFrame:
    """Adds geometry_repaired and repairs what is not valid; a shape of which nothing is left stays as it was.

    Validity is tested for a batch at once, and the invalid shapes of a batch are taken apart together.  ``valid`` names a column for
    the validity of the result, which is known here without a test of its own.
    """
    added = ["geometry_repaired", *([valid] if valid else [])]
    fields = [f for f in df.schema.fields if f.name not in added]
    schema = T.StructType([*fields, T.StructField("geometry_repaired", T.BooleanType(), False), *([T.StructField(valid, T.BooleanType())] if valid else [])])
    df = df.select(*[F.col(f"`{f.name}`") for f in fields])
    at = df.columns.index(geom)

    def run(batches):
        for batch in batches:
            shape = batch.column(at)
            ok = shapes.valid(shape)
            bad = [i for i, sound in enumerate(ok) if sound is False]
            new = repaired_geometries(shape.take(pa.array(bad, pa.int64())))
            sound = [k for k, fine in enumerate(shapes.valid(new)) if fine]
            index = np.arange(len(shape))
            index[[bad[k] for k in sound]] = len(shape) + np.array(sound, np.int64)
            columns = list(batch.columns)
            columns[at] = pa.concat_arrays([shape, new]).take(pa.array(index))
            for k in sound:
                ok[bad[k]] = True
            yield pa.RecordBatch.from_arrays([*columns, pa.array(index >= len(shape)), *([pa.array(ok, pa.bool_())] if valid else [])], names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def simplify(df: DataFrame, geom: str = "geom", tolerance: float = 1e-5) -> DataFrame:
    """Rings with fewer points, none of those left out farther than ``tolerance`` from the line; valid shapes stay valid (see shapes.simplified)."""
    at = df.columns.index(geom)
    names = df.columns

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = shapes.simplified(columns[at], tolerance)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, df.schema)


def outline_edges(geom: Column) -> Column:
    """Directed edges of all rings with what they bound on their left (shells counter-clockwise, holes clockwise), as a, b (a before b) and weight (1, or -1 if the edge runs from b to a)."""

    def one(e: Column, turn: Column) -> Column:
        a, b = F.struct(e.x1.alias("x"), e.y1.alias("y")), F.struct(e.x2.alias("x"), e.y2.alias("y"))
        return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), (turn * F.when(a <= b, 1).otherwise(-1)).cast("int").alias("weight"))

    def ring(r: Column, i: Column) -> Column:
        turn = F.when(i == 0, 1).otherwise(-1) * F.signum(signed_area(r))
        return F.transform(ring_edges(r), lambda e: one(e, turn))

    return F.flatten(F.flatten(F.transform(geom, lambda rings: F.transform(F.filter(rings, lambda r: F.size(r) > 3), ring))))


def dissolve(df: DataFrame, keys: list[str], geom: str = "geom") -> DataFrame:
    """``keys`` and ``geom``: for each key the outline of what its (valid) shapes cover together, as valid polygons.

    Edges are summed by key and ends before they meet, so borders that two shapes share cancel wherever they are;
    what is left of a key, no more than its outline where shapes just touch, is cut and put together by one task.  A key without a shape
    that covers anything has no row.
    """
    rows = df.select(*keys, F.explode(outline_edges(F.col(geom))).alias("e")).select(*keys, "e.*")
    left = rows.groupBy(*keys, "a", "b").agg(F.sum("weight").alias("weight")).where("weight <> 0 and a <> b")
    left = left.select(*keys, *[F.col(f"{p}.{c}").alias(f"_{p}{c}") for p in "ab" for c in "xy"], "weight")
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField(geom, T._parse_datatype_string(GEOMETRY))])
    kind = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))

    def run(table: pa.Table) -> pa.Table:
        edges = np.column_stack([table.column(f"_{p}{c}").to_numpy() for p in "ab" for c in "xy"])
        found = planar.region(edges, table.column("weight").to_numpy(), lambda w: w[:, 0] > 0)
        one = [table.column(k).combine_chunks().slice(0, 1) for k in keys]
        return pa.Table.from_arrays([*one, planar.geometries([found], kind)], names=[f.name for f in schema.fields])

    return left.groupBy(*keys).applyInArrow(run, schema).where(F.col(geom).isNotNull())


def perimeter(geom: Column) -> Column:
    """Length of all rings."""
    return F.aggregate(edges(geom), F.lit(0.0), lambda s, e: s + F.hypot(e.x2 - e.x1, e.y2 - e.y1))
