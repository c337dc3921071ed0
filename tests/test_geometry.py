"""Geometry by hand-checked shapes, and the overlap join."""

import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from concord.functions import geometry as G
from concord.functions import edge_pairs, planar, shapes
from concord.operators import findings, overlap

SQUARE = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]


def geom(*parts):
    return [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in part] for part in parts]


def value(spark, column, a, b=None):
    rows = spark.createDataFrame([(a, b)], f"a {G.GEOMETRY}, b {G.GEOMETRY}")
    return rows.select(column.alias("out")).first()["out"]


def test_area_box_and_validity(spark):
    hole = [(0.5, 0.5), (1, 0.5), (1, 1), (0.5, 1), (0.5, 0.5)]
    assert value(spark, G.area(F.col("a")), geom([SQUARE])) == 4
    assert value(spark, G.area(F.col("a")), geom([SQUARE, hole], [[(5, 5), (5, 6), (6, 6), (5, 5)]])) == 4 - 0.25 + 0.5
    assert tuple(value(spark, G.bbox(F.col("a")), geom([SQUARE]))) == (0, 0, 2, 2)
    bow = [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]
    for shape, ok in ((geom([SQUARE]), True), (geom([bow]), False), (geom([SQUARE[:4]]), False), (geom(), False), (None, None), (geom([[(0, 0), (1, 0), (0, 0), (0, 0)]]), False), (geom([[(0, 0), (math.nan, 0), (1, 1), (0, 0)]]), False)):
        assert value(spark, G.is_valid(F.col("a")), shape) is ok


BOX = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]


@pytest.mark.parametrize(
    "shape, ok",
    [
        ([[(0, 0), (2, 0), (4, 0), (2, 0), (2, 2), (0, 2), (0, 0)]], False),  # a spike
        ([[(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)]], False),  # touches itself
        ([BOX(0, 0, 4), BOX(1, 1, 1)], True),
        ([BOX(0, 0, 4), BOX(0, 1, 1)], False),  # the hole's side lies on the shell's
        ([BOX(0, 0, 4), [(0, 2), (1, 1), (1, 3), (0, 2)]], True),  # the hole touches in a point
        ([BOX(0, 0, 4), BOX(6, 6, 1)], False),  # a hole outside
        ([BOX(0, 0, 4), BOX(3, 3, 3)], False),  # a hole across the shell
        ([BOX(0, 0, 9), BOX(1, 1, 4), BOX(2, 2, 1)], False),  # a hole in a hole
        ([[(0, 0), (1, 0), (1, 0), (1, 1), (0, 0)]], True),  # a point twice
        ([BOX(0, 0, 4), [(0, 2), (2, 1), (2, 3), (0, 2)], [(2, 1), (4, 2), (3, 3), (2, 1)]], False),  # holes that touch cut the inside in two
        ([BOX(0, 0, 4), [(1, 2), (2, 1), (2, 3), (1, 2)], [(2, 1), (4, 2), (3, 3), (2, 1)]], True),  # these don't
        ([BOX(0, 0, 4), [(2, 0), (3, 2), (2, 4), (1, 2), (2, 0)]], False),  # a hole from side to side
    ],
)
def test_validity_of_rings(spark, shape, ok):
    assert value(spark, G.is_valid(F.col("a")), geom(shape)) is ok


def test_validity_of_parts(spark):
    for second, ok in ((BOX(5, 5, 1), True), (BOX(1, 1, 1), False), (BOX(3, 3, 3), False), (BOX(4, 4, 2), True), (BOX(4, 0, 4), False)):
        assert value(spark, G.is_valid(F.col("a")), geom([BOX(0, 0, 4)], [second])) is ok
    assert value(spark, G.is_valid(F.col("a")), geom([BOX(0, 0, 9), BOX(1, 1, 6)], [BOX(2, 2, 1)])) is True  # an island


def test_union_area_and_blocks(spark, monkeypatch):
    from concord.functions import edge_pairs, planar, shapes

    parts = geom([BOX(0, 0, 4)], [BOX(2, 2, 4)], [BOX(3, 3, 1)], [[(10, 0), (12, 0), (11, 2), (10, 0)]], [[(10, 2), (12, 2), (11, 0), (10, 2)]])
    for block in (1 << 20, 5):
        monkeypatch.setattr(edge_pairs, "BLOCK", block)
        import pyarrow as pa

        kind = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))
        got = planar.covered_areas(pa.array([parts, None, geom(), geom([BOX(1, 1, 2)[::-1]])], kind))
        assert got[0] == pytest.approx(16 + 16 - 4 + 3) and got[1:] == [None, 0, 4]
        assert shapes.overlap_areas(pa.array([parts[:1], geom()], kind), pa.array([parts[1:2], parts[:1]], kind)).tolist() == [4, 0]
        assert shapes.valid(pa.array([parts[:1], parts[:2], None, geom()], kind)) == [True, False, None, False]


def test_overlap_area_is_not_in_the_join(spark):
    df = squares(spark, *[(k, "A", f"p{k}", False, k, 0, 10) for k in range(5)])
    plan = overlap.overlap_pairs(df, "key", "source", cell=5.0)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("overlap_area" in j for j in joins) and plan.count("MapInArrow") == 1


def test_srid_and_wkb(spark):
    import struct

    tagged = G.with_srid(F.col("a"), 2927)
    assert value(spark, G.srid(tagged), geom([SQUARE])) == 2927 and value(spark, tagged, None) is None
    assert value(spark, G.srid_fits(tagged, 4326), geom([SQUARE])) is False and value(spark, G.srid_fits(G.with_srid(F.col("a"), 0), 4326), geom([SQUARE])) is True
    p = geom([[(-122.3, 47.6), (-122.2, 47.6), (-122.2, 47.7), (-122.3, 47.6)]])
    moved = value(spark, G.transformed(G.with_srid(F.col("a"), 4326), 3857, (4326, 2927)), p)
    assert moved.srid == 3857 and abs(moved.shape[0][0][0].x + 122.3 * math.pi / 180 * 6378137) < 1e-6
    got = value(spark, G.to_wkb(F.col("a")), geom([SQUARE]))
    assert bytes(got) == struct.pack("<BIIBIII10d", 1, 6, 1, 1, 3, 1, 5, *[v for p in SQUARE for v in p])
    assert value(spark, G.to_wkb(F.col("a")), None) is None
    rings = F.col("a")[0]
    assert len(value(spark, G.multi(rings), geom([SQUARE]))) == 1 and value(spark, G.multi(rings), None) is None


def test_state_plane_against_published_coordinates(spark):
    """The zone's origin lies at its false easting and northing; along its central meridian x stays."""
    for srid, lat0, lon0 in ((2926, 47.0, -120.0 - 50 / 60), (2927, 45.0 + 20 / 60, -120.5)):
        p = value(spark, G.reproject(F.col("a"), 4326, srid), geom([[(lon0, lat0), (lon0, lat0 + 1), (lon0, lat0), (lon0, lat0)]]))[0][0]
        assert abs(p[0].x - 1640416.6666667) < 1e-3 and abs(p[0].y) < 1e-3 and abs(p[1].x - 1640416.6666667) < 1e-3
        assert abs(p[1].y * 1200 / 3937 / 111_180 - 1) < 2e-3  # about 111.2 km for a degree of latitude here


@pytest.mark.parametrize(
    "a, b, area",
    [
        ([[(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)]], [[(0.5, 0.5), (2.5, 0.5), (2.5, 2.5), (0.5, 2.5), (0.5, 0.5)]], 0.75 + 0.5),
        ([[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]], [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]], 12),
        ([[(0, 0), (4, 0), (0, 4), (0, 0)]], [[(0, 0), (4, 4), (0, 4), (0, 0)]], 4),
        ([SQUARE], [[(2, 0), (4, 0), (4, 2), (2, 2), (2, 0)]], 0),
        ([SQUARE], [SQUARE[::-1]], 4),
    ],
)
def test_overlap_area(spark, a, b, area):
    for shift in (0, 1e6):
        move = lambda p: [[(x + shift, y - shift) for x, y in r] for r in p]  # noqa: B023, E731
        assert value(spark, G.overlap_area(F.col("a"), F.col("b")), geom(move(a)), geom(move(b))) == pytest.approx(area, abs=1e-6)


KIND = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def repaired(*parts):
    return G.repaired_geometries(pa.array([geom(*parts)], KIND)).to_pylist()[0]


def fixed(*parts):
    """What repair makes of a geometry: area of each polygon, points of its rings; and it is valid."""
    out = repaired(*parts)
    if out is None:
        return None
    assert shapes.valid(pa.array([out], KIND)) == [True], out
    area = lambda r: sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(r, r[1:])) / 2
    assert all((area(r) > 0) == (i == 0) for p in out for i, r in enumerate(p))
    return sorted((sum(map(area, p)), [len(r) for r in p]) for p in out)


def test_repair():
    assert fixed([[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]]) == [(1, [4]), (1, [4])]  # a bow-tie
    assert fixed([[(0, 0), (2, 0), (2, 0), (2, 2)]]) == [(2, [4])]  # open, a point twice
    assert fixed([[(0, 0), (2, 0), (5, 0), (2, 0), (2, 2), (0, 0)]]) == [(2, [4])]  # a spike
    assert fixed([[(0, 0), (1, 0), (0, 0)]]) is None and fixed([[(0, 0), (math.nan, 0), (1, 1), (0, 0)]]) is None and fixed() is None
    # Loops that overlap: once round each way in one direction, and in opposite ones.
    loops = [*BOX(0, 0, 4), *BOX(2, 2, 4), (0, 0)]
    assert fixed([loops]) == [(28, [9])]
    assert fixed([[*BOX(0, 0, 4), *BOX(2, 2, 4)[::-1], (0, 0)]]) == [(12, [7]), (12, [7])]
    star = [(math.cos(2 * math.pi * k * 2 / 5), math.sin(2 * math.pi * k * 2 / 5)) for k in range(5)]
    ((area, sizes),) = fixed([[*star, star[0]]])
    assert sizes == [11] and area == pytest.approx(1.122569941449)
    # Holes: across the shell, over each other, outside; a part in another's hole, and one over another.
    assert fixed([BOX(0, 0, 4), BOX(3, 3, 3)]) == [(15, [7])]
    assert fixed([BOX(0, 0, 9), BOX(1, 1, 4), BOX(3, 3, 4)[::-1]]) == [(81 - 28, [5, 9])]
    assert fixed([BOX(0, 0, 4), BOX(8, 8, 1)]) == [(16, [5])]
    assert fixed([BOX(0, 0, 9), BOX(1, 1, 6)], [BOX(2, 2, 1)]) == [(1, [5]), (45, [5, 5])]
    assert fixed([BOX(0, 0, 4)], [BOX(2, 2, 4)], [BOX(10, 0, 1)]) == [(1, [5]), (28, [9])]
    # A ring that touches itself: the shell and its hole come apart; loops that touch in a point are two parts.
    assert fixed([[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0), (1, 2), (2, 1), (0, 0)]]) in ([(16 - 1.5, [5, 4])], [(16 + 0.0, [5])])
    assert fixed([[*BOX(0, 0, 2), *BOX(2, 2, 2), (0, 0)]]) == [(4, [5]), (4, [5])]


def test_crossings_on_axes_are_exact():
    """Two loops against each other whose crossing, as a part of the one edge, isn't on the other by rounding."""
    for k, s in ((4269973, 47), (4246973, 47), (4222919, 47), (4211973, 47)):
        x, y, dx, dy = k * 37 % 1000, k * 91 % 1000, k % 13, k % 7
        out = fixed([[*BOX(x, y, s), *BOX(x + dx, y + dy, s)[::-1], (x, y)]])
        assert sum(a for a, _ in out) == 2 * s * s - 2 * (s - dx) * (s - dy), (k, out)


def crossings(n):
    """A zigzag there and back: n crossings."""
    there = [(float(i), float(i % 2)) for i in range(n + 1)]
    return [*there, *[(x, 1 - y) for x, y in there[::-1]], there[0]]


def test_repair_of_many_crossings_and_points():
    out = fixed([crossings(500)])
    assert len(out) == 501 and sum(a for a, _ in out) == pytest.approx(250)  # two triangles at the ends
    n = 100_000
    ring = [(math.cos(2 * math.pi * k / n) * (1 + 0.001 * (k % 2)), math.sin(2 * math.pi * k / n) * (1 + 0.001 * (k % 2))) for k in range(n)]
    assert shapes.valid(pa.array([geom([[*ring, ring[0]]])], KIND)) == [True]
    ring[10], ring[14] = ring[14], ring[10]
    start = time.perf_counter()
    assert shapes.valid(pa.array([geom([[*ring, ring[0]]])], KIND)) == [False]
    out = fixed([[*ring, ring[0]]])
    assert time.perf_counter() - start < 60
    assert sum(a for a, _ in out) == pytest.approx(math.pi, rel=0.01)


def test_regions_by_points():
    """Random rings: a point is inside a repaired shape if the rings wind round it."""
    rng = random.Random(11)

    def winding(ring, x, y):
        n = 0
        for (a, b), (c, d) in zip(ring, [*ring[1:], ring[0]]):
            if (b <= y) != (d <= y) and x < a + (y - b) * (c - a) / (d - b):
                n += 1 if d > b else -1
        return n

    for trial in range(120):
        grid = trial % 2  # corners on a small grid meet edges and each other
        pick = (lambda: float(rng.randint(0, 6))) if grid else (lambda: rng.uniform(0, 6))
        ring = [(pick(), pick()) for _ in range(rng.randint(3, 14))]
        out = repaired([ring])
        if out is not None:
            assert shapes.valid(pa.array([out], KIND)) == [True], ring
        rings = [[(p["x"], p["y"]) for p in r[:-1]] for part in out or [] for r in part]
        for _ in range(60):
            x, y = rng.uniform(-0.5, 6.5), rng.uniform(-0.5, 6.5)
            assert (winding(ring, x, y) != 0) == (sum(winding(r, x, y) for r in rings) == 1), (ring, x, y)


def test_a_batch_is_repaired_like_its_shapes(spark):
    """Shapes of a batch lie over each other, repeat, and are null or empty among sound ones; each comes out as it does alone."""
    rng = random.Random(5)
    pick = lambda: (float(rng.randint(0, 6)), float(rng.randint(0, 6)))
    batch = [geom(*[[[pick() for _ in range(rng.randint(0, 9))] for _ in range(rng.randint(1, 3))] for _ in range(rng.randint(1, 3))]) for _ in range(150)]
    batch += [None, geom(), geom([[]]), geom([BOX(0, 0, 4)], [BOX(8, 8, 1)]), batch[3], batch[3]]
    got = G.repaired_geometries(pa.array(batch, KIND))
    assert got.to_pylist() == [G.repaired_geometries(pa.array([g], KIND)).to_pylist()[0] for g in batch]
    assert all(v in (None, True) for v in shapes.valid(got)) and got.null_count < 60
    sliced = pa.array(batch, KIND).slice(7, 90)
    assert G.repaired_geometries(sliced).to_pylist() == got.to_pylist()[7:97]
    rows = spark.createDataFrame([(k, g) for k, g in enumerate(batch)], f"k int, geom {G.GEOMETRY}").coalesce(1)
    found = {r.k: r for r in G.repair(rows, valid="ok").collect()}
    assert all(found[k].geometry_repaired == (ok is False and new is not None) for k, (ok, new) in enumerate(zip(shapes.valid(pa.array(batch, KIND)), got.to_pylist())))


def test_sweep_finds_the_pairs_of_all_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    group = np.sort(rng.integers(0, 5, 400))
    x1, y1, x2, y2 = (np.round(rng.random(400) * 20, 1) for _ in range(4))
    x2, y2 = x1 + (x2 - x1) * 0.1, y1 + (y2 - y1) * 0.1
    found = []
    for few, block in ((1_000, 1 << 20), (0, 1 << 20), (0, 50)):
        monkeypatch.setattr(edge_pairs, "FEW", few)
        monkeypatch.setattr(edge_pairs, "BLOCK", block)
        found.append(sorted((int(i), int(j)) for a, b in edge_pairs.near_pairs(group, x1, y1, x2, y2) for i, j in zip(a, b)))
    assert found[0] == found[1] == found[2] and len(found[0]) > 50


def test_overlaps_of_large_shapes_by_the_sweep(monkeypatch):
    rng = random.Random(9)

    def star(n):
        x, y = rng.random(), rng.random()
        ring = [(x + r * math.cos(2 * math.pi * k / n), y + r * math.sin(2 * math.pi * k / n)) for k in range(n) for r in [0.5 + rng.random()]]
        return geom([[*ring, ring[0]]])

    left, right = (pa.array([star(rng.randint(3, 60)) for _ in range(20)] + [geom()], KIND) for _ in "ab")
    want = shapes.overlap_areas(left, right)
    for few, block in ((0, 1 << 20), (0, 64), (10_000, 100)):
        monkeypatch.setattr(edge_pairs, "FEW", few)
        monkeypatch.setattr(edge_pairs, "BLOCK", block)
        assert np.allclose(shapes.overlap_areas(left, right), want, atol=1e-9)
    assert (want[:20] > 0).any() and want[20] == 0


def test_dissolved_outlines(spark):
    """Squares that share whole sides, parts of sides, corners or ground; a hole between them; a hot border."""
    cells = [("touch", BOX(0, 0, 1)), ("touch", BOX(1, 0, 1)[::-1]), ("part", BOX(0, 0, 2)), ("part", BOX(2, 1, 4)), ("corner", BOX(0, 0, 1)), ("corner", BOX(1, 1, 1)), ("over", BOX(0, 0, 4)), ("over", BOX(2, 2, 4)), ("twice", BOX(0, 0, 1)), ("twice", BOX(0, 0, 1))]
    cells += [("ring", BOX(x, y, 1)) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    rows = [(k, geom([r])) for k, r in cells] + [("holed", geom([BOX(0, 0, 9), BOX(1, 1, 6)])), ("holed", geom([BOX(2, 2, 1)])), ("none", None), ("none", geom()), (None, geom([BOX(0, 0, 1)]))]
    df = spark.createDataFrame(rows, f"k string, geom {G.GEOMETRY}").repartition(4)
    out = G.dissolve(df, ["k"]).select("k", G.area(F.col("geom")).alias("a"), G.perimeter(F.col("geom")).alias("p"), G.is_valid(F.col("geom")).alias("ok"), F.transform("geom", lambda part: F.transform(part, F.size)).alias("n")).collect()
    assert all(r.ok for r in out)
    assert {r.k: (r.a, r.p, sorted(r.n)) for r in out} == {
        "touch": (2, 6, [[7]]),
        "part": (20, 22, [[9]]),
        "corner": (2, 8, [[5], [5]]),
        "over": (28, 24, [[9]]),
        "twice": (1, 4, [[5]]),
        "ring": (8, 16, [[13, 5]]),
        "holed": (46, 64, [[5], [5, 5]]),
        None: (1, 4, [[5]]),
    }


def thinner(ring, tolerance, *others):
    new = shapes.simplified(pa.array([geom([ring, *others])], KIND), tolerance).to_pylist()[0]
    return [[(p["x"], p["y"]) for p in r] for r in new[0]]


def test_simplification():
    assert thinner([(0, 0), (1, 0), (2, 0), (2, 2), (0, 2), (0, 0)], 0.1) == [SQUARE]
    assert len(thinner([(0, 0), (1e-7, 0), (1e-7, 1e-7), (0, 1e-7), (0, 0)], 1)[0]) >= 4
    rng = random.Random(4)

    def plain(ring, tolerance):
        """Splitting at the farthest point, one line after another."""

        def far(a, b, p):
            dx, dy = b[0] - a[0], b[1] - a[1]
            size = math.hypot(dx, dy)
            return math.hypot(p[0] - a[0], p[1] - a[1]) if size == 0 else abs(dx * (p[1] - a[1]) - (p[0] - a[0]) * dy) / size

        keep = {0, len(ring) - 1, max(range(len(ring)), key=lambda i: math.hypot(ring[i][0] - ring[0][0], ring[i][1] - ring[0][1]))}
        todo = list(zip(sorted(keep), sorted(keep)[1:]))
        while todo:
            i, j = todo.pop()
            if j - i > 1 and far(ring[i], ring[j], ring[k := max(range(i + 1, j), key=lambda k: far(ring[i], ring[j], ring[k]))]) > tolerance:
                keep.add(k)
                todo += [(i, k), (k, j)]
        return [ring[i] for i in sorted(keep)]

    for _ in range(30):
        n = rng.randint(5, 200)
        ring = [(r * math.cos(2 * math.pi * k / n), r * math.sin(2 * math.pi * k / n)) for k in range(n) for r in [5 + rng.random()]]
        ring.append(ring[0])
        got = thinner(ring, 0.3)[0]
        assert set(plain(ring, 0.3)) <= set(got) and shapes.valid(pa.array([geom([got])], KIND)) == [True]


def test_simplification_keeps_shapes_valid(spark):
    """Without the tip of the shell the hole in it would lie outside; a line may not cut a neck."""
    shell = [(0, 0), (10, 0), (10, 10), (5, 10.4), (0, 10), (0, 0)]
    hole = [(4.8, 10.1), (5.2, 10.1), (5, 10.2), (4.8, 10.1)]
    df = spark.createDataFrame([(1, geom([shell, hole])), (2, geom([shell])), (3, None), (4, geom())], f"k int, geom {G.GEOMETRY}")
    got = {r.k: None if r.geom is None else [len(ring) for part in r.geom for ring in part] for r in G.simplify(df, tolerance=0.5).collect()}
    assert got == {1: [6, 4], 2: [5], 3: None, 4: []}
    # Only what is in the way comes back: the rest of the outline stays simplified.
    n = 60
    wavy = [(k / 10, -0.01 * (k % 2)) for k in range(10 * n + 1)]
    ring = [*wavy, (60, 10), (31, 10), (30, 0.05), (29, 10), (0, 10), (0, 0)]
    ring = [(x, y if 0 < y or abs(x - 30) > 3 else y - 0.2 * (1 - abs(x - 30) / 3)) for x, y in ring]
    new = thinner(ring, 0.4)[0]
    assert shapes.valid(pa.array([geom([ring]), geom([new])], KIND)) == [True, True] and len(new) < 30


def squares(spark, *rows):
    data = [(k, s, p, st, geom([[(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]])) for k, s, p, st, x, y, w in rows]
    return spark.createDataFrame(data, f"key int, source string, parent string, stacked boolean, geom {G.GEOMETRY}")


def test_overlap_join(spark):
    df = squares(
        spark,
        (1, "A", "p1", False, 0, 0, 10),
        (2, "A", "p2", False, 1, 0, 10),  # 0.9 of 1
        (3, "A", "p3", True, 5, 0, 10),  # half of 1
        (4, "A", "p4", True, 5, 0, 10),  # both stacked
        (5, "A", "p5", None, 10, 0, 10),  # touches 1
        (6, "B", "p6", False, 0, 0, 10),  # another source
        (7, "A", "p1", False, 0, 0, 10),  # the parent of 1
        (8, "A", "p8", False, -500, -500, 5000),  # touches a great many cells
    )
    for cell in (3.0, 20.0, None):
        out = overlap.classify_overlaps(overlap.overlap_pairs(df, "key", "source", parent="parent", stacked="stacked", cell=cell), "stacked")
        got = {(r.key_a, r.key_b): (round(r.overlap_ratio, 6), r.overlap_class, r.unflagged_coincident) for r in out.collect()}
        assert got[1, 2] == (0.9, "coincident", True) and got[1, 3] == (0.5, "encroachment", False)
        assert not {(3, 4), (1, 5), (1, 6), (1, 7)} & set(got)
        assert {(k, 8) for k in (1, 2, 3, 4, 5, 7)} <= set(got)
        assert set(got) == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (2, 5), (2, 7), (3, 5), (4, 5), (3, 7), (4, 7)} | {(k, 8) for k in (1, 2, 3, 4, 5, 7)}
    assert overlap.overlap_pairs(df.limit(0), "key", "source", cell=1.0).count() == 0


def test_copies_of_shapes_meet_as_one(spark, monkeypatch):
    """Many copies of few shapes, in slices: all pairs, their number and the lists of counterparts, by brute force."""
    rng = random.Random(9)
    kinds = [(rng.choice("AB"), rng.choice([True, False, None]), rng.randint(0, 12), rng.randint(0, 12), rng.randint(2, 6)) for _ in range(20)]
    rows = [(k, src, rng.choice([f"p{k // 3}", f"p{k // 3}", None]), st, x, y, w) for k in range(130) for src, st, x, y, w in [rng.choice(kinds)]]
    wanted = {}
    for i, (k, s, p, st, x, y, w) in enumerate(rows):
        for m, t, q, su, u, v, z in rows[i + 1 :]:
            dx, dy = min(x + w, u + z) - max(x, u), min(y + w, v + z) - max(y, v)
            if s == t and p and q and p != q and not (st and su) and dx > 0 and dy > 0 and dx * dy > 1:
                wanted[k, m] = (float(dx * dy), w * w, z * z, p, q, st, su)
    monkeypatch.setattr(overlap, "SLICE", 3)
    df = squares(spark, *rows).repartition(5)
    out = overlap.overlap_pairs(df, "key", "source", parent="parent", stacked="stacked")
    got = {(r.key_a, r.key_b): (r.overlap_area, r.area_a, r.area_b, r.parent_a, r.parent_b, r.stacked_a, r.stacked_b) for r in out.collect()}
    assert got == wanted and out.count() == len(wanted) > 300
    # Tables are never broadcast by the size of their file: rows of a small one make large shapes.
    assert "BroadcastExchange" not in out._jdf.queryExecution().sparkPlan().toString()
    counted = overlap.counted_pairs(df, "key", "source", parent="parent", stacked="stacked").agg(F.sum("n_pairs"), F.sum(F.col("n_pairs") * F.col("overlap_area")), F.min("n_pairs")).first()
    assert counted[0] == len(wanted) and counted[1] == sum(a for a, *_ in wanted.values()) and counted[2] > 0
    members, reach = overlap.parents_in_reach(df, "key", "source", "parent", stacked="stacked", flags={"alike": F.col("overlap_class") == "coincident"})
    lists = {r.key: r for r in findings.reached_counterparts(members, reach, "key", "parent", ["alike"]).collect()}
    directed = [(k, q, a, a / min(b, c) >= 0.8) for (k, m), (a, b, c, p, q, *_) in wanted.items()] + [(m, p, a, a / min(b, c) >= 0.8) for (k, m), (a, b, c, p, q, *_) in wanted.items()]
    plain = {r.key: r for r in findings.counterparts(spark.createDataFrame(directed, "key int, counterpart string, area double, flag boolean"), ["key"], "counterpart", "area", {"alike": F.col("flag")}).collect()}
    assert {k: (r.n_counterparts, r.counterparts, r.alike) for k, r in lists.items()} == {k: (r.n_counterparts, r.counterparts, r.alike) for k, r in plain.items()}


def test_reach_has_a_row_for_each_class(spark):
    """Counterparts are not listed for each class: copies of a shape, parents in many places and ties make no more rows."""
    rows = [(k, "A", f"p{k:02}", False, 10 * (k % 2), 0, 12) for k in range(40)]
    # One parent in three places, two of which meet shapes of the others; another meets itself alone.
    rows += [(50, "A", "q", False, 20, 0, 5), (51, "A", "q", False, 8, 8, 5), (52, "A", "q", True, 500, 0, 5), (60, "A", "r", False, 900, 0, 5), (61, "A", "r", False, 902, 0, 5), (62, "B", "p00", None, 0, 0, 9)]
    members, reach = overlap.parents_in_reach(squares(spark, *rows), "key", "source", "parent", stacked="stacked", flags={"alike": F.col("overlap_class") == "coincident"})
    assert reach.count() == 6  # two of forty, two of q, two of r
    lists = {r.key: (r.n_counterparts, r.counterparts, r.alike) for r in findings.reached_counterparts(members, reach, "key", "parent", ["alike"]).collect()}
    for k in range(40):
        same = [f"p{m:02} (144)" for m in range(k % 2, 40, 2) if m != k]
        assert lists[k] == (40, "; ".join(same[:5]), True)
    assert lists[50] == (20, "; ".join(f"p{m:02} (10)" for m in range(1, 10, 2)), False)
    assert lists[51] == (40, "; ".join(f"p{m:02} (16)" for m in range(0, 10, 2)), False)
    assert set(lists) == {*range(40), 50, 51}


def test_shapes_that_fill_their_boxes(spark):
    def fills(g):
        return value(spark, G.fills(F.col("a"), G.bbox(F.col("a"))), g)

    assert fills(geom([BOX(0.1, 0.7, 3.3)])) and fills(geom([BOX(1, 1, 2)[::-1]])) and fills(geom([[(2, 0), (2, 2), (0, 2), (0, 0), (2, 0)]]))
    hole, bow = [(0.5, 0.5), (1, 0.5), (1, 1), (0.5, 1), (0.5, 0.5)], [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]
    odd = [geom([SQUARE[:4]]), geom([SQUARE, hole]), geom([SQUARE], [SQUARE]), geom([bow]), geom([[(0, 0), (2, 0), (0, 2), (0, 0)]]), geom([[(0, 0), (2, 0), (2, 2), (1, 2), (0, 0)]])]
    odd += [geom(), None, geom([[(0, 0), (0, 0), (0, 0), (0, 0), (0, 0)]]), geom([[(math.nan, 0), (2, 0), (2, 2), (0, 2), (math.nan, 0)]]), geom([[(0, 0), (math.inf, 0), (math.inf, 2), (0, 2), (0, 0)]])]
    assert [fills(g) for g in odd] == [False] * len(odd)


def test_boxes_and_other_shapes_overlap_alike(spark):
    """Squares, triangles and both together: areas as the edges give them."""
    rng = random.Random(12)
    data = []
    for k in range(90):
        x, y, w = rng.randint(0, 30), rng.randint(0, 30), rng.randint(2, 9)
        ring = [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)] if k % 3 else [(x, y), (x + w, y), (x, y + w), (x, y)]
        data.append((k, "A", geom([ring])))
    kind = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))
    for some in (data, [d for d in data if d[0] % 3], [d for d in data if d[0] % 3 == 0]):
        pairs = [(a, b) for i, a in enumerate(some) for b in some[i + 1 :]]
        areas = shapes.overlap_areas(pa.array([a[2] for a, _ in pairs], kind), pa.array([b[2] for _, b in pairs], kind))
        wanted = {(a[0], b[0]): pytest.approx(v, abs=1e-9) for (a, b), v in zip(pairs, areas) if v > 1.1}
        got = overlap.overlap_pairs(spark.createDataFrame(some, f"key int, source string, geom {G.GEOMETRY}"), "key", "source", least_area=1.1).collect()
        assert {(r.key_a, r.key_b): r.overlap_area for r in got} == wanted and len(got) == len(wanted) > 20


def box_frame(spark, rows):
    data = [(k, src, (float(x), float(y), float(x + w), float(y + h))) for k, src, x, y, w, h in rows]
    return spark.createDataFrame(data, "key long, source string, box struct<x0:double,y0:double,x1:double,y1:double>").repartition(8)


def brute_pairs(rows):
    out = set()
    for i, (k, s, x, y, w, h) in enumerate(rows):
        for m, t, u, v, p, q in rows[i + 1 :]:
            if s == t and x < u + p and u < x + w and y < v + q and v < y + h:
                out.add((min(k, m), max(k, m)))
    return out


@pytest.mark.parametrize("cell", [0.5, 7.0, 100_000.0])
def test_candidates_of_mixed_sizes(spark, cell):
    rng = random.Random(6)
    rows = [(k, rng.choice("AB"), rng.uniform(-300, 300), rng.uniform(-300, 300), rng.choice([0.1, 1, 4, 30, 700]) * rng.random(), rng.choice([0.1, 1, 4, 30, 700]) * rng.random()) for k in range(700)]
    got = [(r.key_a, r.key_b) for r in overlap.candidate_pairs(box_frame(spark, rows), "key", "source", cell).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(rows)


def test_crowded_cells_are_dealt_over_slices(spark, monkeypatch):
    """Copies of one box among others: the same pairs, and no (cell, slice) with many more searching rows than the bound."""
    rng = random.Random(7)
    rows = [(k, "A", 10, 10, 3, 3) for k in range(300)] + [(k, "A", rng.uniform(0, 90), rng.uniform(0, 90), rng.uniform(1, 9), 2) for k in range(300, 900)]
    df = box_frame(spark, rows)
    searching, home = overlap.posted(df, "key", "source", 2.0, most=50)
    where = ["at", "cx", "cy"]
    n = {tuple(r[:4]): r["count"] for r in searching.groupBy(*where, "slice").count().collect()}
    whole = {tuple(r[:3]): r["count"] for r in searching.groupBy(*where).count().collect()}
    assert max(whole.values()) > 300 and max(n.values()) <= 100
    copies = {tuple(r[:3]): r["count"] for r in home.where("key = 0").groupBy(*where).count().collect()}
    assert all(c == -(-whole[w] // 50) for w, c in copies.items())
    monkeypatch.setattr(overlap, "SLICE", 50)
    got = [(r.key_a, r.key_b) for r in overlap.candidate_pairs(df, "key", "source", 2.0).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(rows)


def test_state_plane_round_trip(spark):
    p = geom([[(-122.3, 47.6), (-122.2, 47.6), (-122.2, 47.7), (-122.3, 47.6)]])
    for srid in (2926, 2927, 3857):
        back = value(spark, G.reproject(G.reproject(F.col("a"), 4326, srid), srid, 4326), p)
        assert all(abs(q.x - w["x"]) < 1e-9 and abs(q.y - w["y"]) < 1e-9 for q, w in zip(back[0][0], p[0][0]))


def test_point_lookup_and_geojson(spark):
    assert value(spark, G.contains(F.col("a"), F.lit(1.0), F.lit(1.0)), geom([SQUARE])) is True
    assert value(spark, G.contains(F.col("a"), F.lit(3.0), F.lit(1.0)), geom([SQUARE])) is False
    assert value(spark, G.to_geojson(F.col("a")), geom([[(0, 0), (1, 0), (1, 1), (0, 0)]])) == '{"type":"MultiPolygon","coordinates":[[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,0.0]]]]}'
