"""Edges against edges, in numpy over Arrow arrays of geometries (parts -> rings -> points).

All shapes of a batch are taken at once: pairs of edges come in blocks (``edge_pairs``), so memory stays bounded and
there is no loop over shapes.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from . import edge_pairs, planar
from .edge_pairs import blocks, near_pairs, sweep



# The byte order and type numbers of well-known binary.
_LITTLE, _POLYGON, _MULTIPOLYGON = 1, 3, 6


def wkb(geoms: pa.Array) -> list[bytes | None]:
    """Each geometry as a MultiPolygon in well-known binary."""
    out: list[bytes | None] = []
    for g in geoms:
        if not g.is_valid:
            out.append(None)
            continue
        data = [struct.pack("<BII", _LITTLE, _MULTIPOLYGON, len(g))]
        for rings in g.as_py():
            data.append(struct.pack("<BII", _LITTLE, _POLYGON, len(rings)))
            for ring in rings:
                data.append(struct.pack(f"<I{2 * len(ring)}d", len(ring), *(v for p in ring for v in (p["x"], p["y"]))))
        out.append(b"".join(data))
    return out


@dataclass
class Edges:
    """The directed edges of many geometries, in order; ``sign`` is 1 or -1 as an edge runs with or against a wound ring."""

    x1: np.ndarray
    y1: np.ndarray
    x2: np.ndarray
    y2: np.ndarray
    ring: np.ndarray
    geom: np.ndarray
    sign: np.ndarray
    #: For each geometry the first of its edges, and one more number.
    start: np.ndarray
    #: For each ring: its part, its area, whether it is closed, finite and long enough, whether it is a shell.
    part: np.ndarray
    area: np.ndarray
    whole: np.ndarray
    shell: np.ndarray
    geom_of_part: np.ndarray


def _sizes(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def edges_of(geoms: pa.Array) -> Edges:
    n_parts = _sizes(geoms)
    parts = geoms.flatten()
    n_rings = _sizes(parts)
    rings = parts.flatten()
    n_points = _sizes(rings)
    points = rings.flatten()
    x, y = (points.field(i).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float) for i in (0, 1))
    geom_of_part = np.repeat(np.arange(len(n_parts)), n_parts)
    part = np.repeat(np.arange(len(n_rings)), n_rings)
    ring = np.repeat(np.arange(len(n_points)), n_points)
    first = np.cumsum(n_points) - n_points
    shell = np.zeros(len(n_points), bool)
    shell[(np.cumsum(n_rings) - n_rings)[n_rings > 0]] = True
    whole = n_points >= 4
    full = np.flatnonzero(n_points > 0)
    ends = first[full] + n_points[full] - 1
    whole[full] &= (x[first[full]] == x[ends]) & (y[first[full]] == y[ends])
    whole &= np.bincount(ring, ~(np.isfinite(x) & np.isfinite(y)), len(n_points)) == 0
    last = np.zeros(len(x), bool)
    last[ends] = True
    a = np.flatnonzero(~last)
    of_ring = ring[a]
    x0, y0 = x[first[of_ring]], y[first[of_ring]]
    with np.errstate(invalid="ignore", over="ignore"):
        cross = (x[a] - x0) * (y[a + 1] - y0) - (x[a + 1] - x0) * (y[a] - y0)
        area = np.bincount(of_ring, cross, len(n_points)) / 2
        sign = np.where(shell[of_ring], 1.0, -1.0) * np.sign(area[of_ring])
    geom = geom_of_part[part[of_ring]]
    start = np.concatenate(([0], np.cumsum(np.bincount(geom, minlength=len(n_parts)))))
    return Edges(x[a], y[a], x[a + 1], y[a + 1], of_ring, geom, sign, start, part, area, whole, shell, geom_of_part)


def _facing(a: Edges, b: Edges):
    """Blocks of (edge of a, edge of b) of one pair of geometries: all of small ones, those whose x overlap of large ones."""
    few = np.diff(a.start) * np.diff(b.start) <= edge_pairs.FEW**2
    own = np.flatnonzero(few[a.geom])
    for i, j, _ in blocks(own, b.start[a.geom[own]], b.start[a.geom[own] + 1]):
        yield i, j
    i, j = np.flatnonzero(~few[a.geom]), np.flatnonzero(~few[b.geom])
    n = len(i)
    if not n or not len(j):
        return
    ends = [np.concatenate([f(e.x1[k], e.x2[k]) for e, k in ((a, i), (b, j))]) for f in (np.minimum, np.maximum)]
    order, stop = sweep(np.concatenate((a.geom[i], b.geom[j])), *ends)
    for p, q, _ in blocks(np.arange(len(order)), np.arange(len(order)) + 1, stop):
        p, q = np.minimum(order[p], order[q]), np.maximum(order[p], order[q])
        both = np.flatnonzero((p < n) & (q >= n))
        yield i[p[both]], j[q[both] - n]


def overlap_areas(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Area common to each pair of geometries of simple rings.

    The area under an edge is signed by its direction; the overlap is the signed sum, over all pairs of edges,
    of the area under both at once, in coordinates local to the pair (against cancellation).
    """
    a, b = edges_of(left), edges_of(right)
    n = len(left)
    low_x, low_y = np.full(n, np.inf), np.full(n, np.inf)
    for e in (a, b):
        np.minimum.at(low_x, e.geom, np.minimum(e.x1, e.x2))
        np.minimum.at(low_y, e.geom, np.minimum(e.y1, e.y2))
    out = np.zeros(n)
    pair = a.geom
    for i, j in _facing(a, b):
        lo = np.maximum(np.minimum(a.x1[i], a.x2[i]), np.minimum(b.x1[j], b.x2[j]))
        hi = np.minimum(np.maximum(a.x1[i], a.x2[i]), np.maximum(b.x1[j], b.x2[j]))
        both = np.flatnonzero(lo < hi)
        i, j, lo, hi = i[both], j[both], lo[both], hi[both]
        p = pair[i]

        def height(e: Edges, k: np.ndarray, x: np.ndarray) -> np.ndarray:
            return e.y1[k] - low_y[p] + (x - e.x1[k]) * (e.y2[k] - e.y1[k]) / (e.x2[k] - e.x1[k])  # noqa: B023

        e0, e1, f0, f1 = height(a, i, lo), height(a, i, hi), height(b, j, lo), height(b, j, hi)
        d0, d1 = e0 - f0, e1 - f1
        m0, m1 = np.minimum(e0, f0), np.minimum(e1, f1)
        cross = d0 * d1 < 0
        t = np.where(cross, d0 / np.where(cross, d0 - d1, 1.0), 0.0)
        mid = e0 + t * (e1 - e0)
        mean = np.where(cross, t * (m0 + mid) + (1 - t) * (mid + m1), m0 + m1) / 2
        sign = a.sign[i] * b.sign[j] * np.sign(a.x2[i] - a.x1[i]) * np.sign(b.x2[j] - b.x1[j])
        out += np.bincount(p, sign * (hi - lo) * mean, n)
    return np.abs(out)


def valid(geoms: pa.Array) -> list[bool | None]:
    """Validity of each geometry, as ``geometry.is_valid`` states it."""
    return judged(geoms)[0]


def judged(geoms: pa.Array) -> tuple[list[bool | None], np.ndarray]:
    """Validity of each geometry, and a mask of the edges (in the order of ``edges_of``) that meet another as they may not."""
    e = edges_of(geoms)
    crossed, touching = np.zeros(len(e.x1), bool), np.zeros(len(e.geom_of_part), bool)
    n, n_rings = len(geoms), len(e.part)
    geom_of_ring = e.geom_of_part[e.part] if n_rings else np.zeros(0, np.int64)
    bad = np.bincount(geom_of_ring, minlength=n) == 0  # empty
    np.logical_or.at(bad, geom_of_ring, ~(e.whole & (np.abs(e.area) > 0)))
    # Edges of sound rings that have a length.
    with np.errstate(invalid="ignore"):
        keep = e.whole[e.ring] & ((e.x1 != e.x2) | (e.y1 != e.y2))
    numbers = np.flatnonzero(keep)
    x1, y1, x2, y2, ring, geom = (v[keep] for v in (e.x1, e.y1, e.x2, e.y2, e.ring, e.geom))
    ring_first, ring_last = np.searchsorted(ring, ring), np.searchsorted(ring, ring, side="right") - 1

    def side(i, x, y):
        return np.sign((x2[i] - x1[i]) * (y - y1[i]) - (y2[i] - y1[i]) * (x - x1[i]))

    def within(i, x, y):
        return (np.minimum(x1[i], x2[i]) <= x) & (x <= np.maximum(x1[i], x2[i])) & (np.minimum(y1[i], y2[i]) <= y) & (y <= np.maximum(y1[i], y2[i]))

    for i, j in near_pairs(geom, x1, y1, x2, y2):
        s = [side(j, x1[i], y1[i]), side(j, x2[i], y2[i]), side(i, x1[j], y1[j]), side(i, x2[j], y2[j])]
        proper = (s[0] * s[1] < 0) & (s[2] * s[3] < 0)
        touch = proper | ((s[0] == 0) & within(j, x1[i], y1[i])) | ((s[1] == 0) & within(j, x2[i], y2[i])) | ((s[2] == 0) & within(i, x1[j], y1[j])) | ((s[3] == 0) & within(i, x2[j], y2[j]))
        line = (s[0] == 0) & (s[1] == 0) & (s[2] == 0) & (s[3] == 0)
        wide = np.maximum(np.minimum(np.maximum(x1[i], x2[i]), np.maximum(x1[j], x2[j])) - np.maximum(np.minimum(x1[i], x2[i]), np.minimum(x1[j], x2[j])), np.minimum(np.maximum(y1[i], y2[i]), np.maximum(y1[j], y2[j])) - np.maximum(np.minimum(y1[i], y2[i]), np.minimum(y1[j], y2[j])))
        along = line & (wide > 0)
        same = ring[i] == ring[j]
        beside = same & ((j == i + 1) | ((i == ring_first[i]) & (j == ring_last[j])))
        wrong = np.where(beside, along, np.where(same, touch, proper | along))
        bad[geom[i[wrong]]] = True
        touching[e.part[ring[i[touch & ~same & (e.part[ring[i]] == e.part[ring[j]])]]]] = True
        crossed[numbers[i[wrong]]] = crossed[numbers[j[wrong]]] = True
    for g in np.flatnonzero(~bad & (np.bincount(geom_of_ring, minlength=n) > 1)):
        bad[g] = not _nested(e, int(g))
    split = np.flatnonzero(touching & ~bad[e.geom_of_part])
    bad[e.geom_of_part[split[_inside_splits(e, split)]]] = True
    known = geoms.is_valid().to_pylist()
    return [not b if k else None for b, k in zip(bad.tolist(), known)], crossed


def simplified(geoms: pa.Array, tolerance: float) -> pa.Array:
    """Each ring with fewer points: a line between two that stay leaves out points at most ``tolerance`` from it.

    All rings are split together, each line at its farthest point, until none is too far (a round for each depth of the
    splits).  A ring keeps four points and an area.  Where a valid shape wouldn't be valid, the lines that meet others get
    back their farthest points, and all lines of the shape where none meet (a hole outside, say), until it is.
    """
    n_parts = _sizes(geoms)
    parts = geoms.flatten()
    n_rings = _sizes(parts)
    rings = parts.flatten()
    n_points = _sizes(rings)
    points = rings.flatten()
    if not len(points):
        return geoms
    x, y = (points.field(i).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float) for i in (0, 1))
    first = (np.cumsum(n_points) - n_points)[n_points > 0]
    size = n_points[n_points > 0]
    ring = np.repeat(np.arange(len(size)), size)
    geom = np.repeat(np.arange(len(n_parts)), n_parts)[np.repeat(np.arange(len(n_rings)), n_rings)][n_points > 0]
    keep = (size <= 4)[ring]
    keep[first] = keep[first + size - 1] = True
    away = np.hypot(x - x[first][ring], y - y[first][ring])
    keep[_first_of_largest(away, first)] = True

    def farthest() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The kept points; the farthest point behind each (itself where there is none before the next), and how far it is."""
        at = np.flatnonzero(keep)
        line = np.cumsum(keep) - 1
        a, b = at[line], at[np.minimum(line + 1, len(at) - 1)]
        dx, dy = x[b] - x[a], y[b] - y[a]
        length = np.hypot(dx, dy)
        with np.errstate(invalid="ignore", divide="ignore"):
            far = np.where(length == 0, np.hypot(x - x[a], y - y[a]), np.abs(dx * (y - y[a]) - (x - x[a]) * dy) / length)
        far[keep] = -1.0
        k = _first_of_largest(far, at)
        return at, k, far[k]

    def built() -> pa.Array:
        left = np.add.reduceat(keep, first) if len(first) else first
        sizes = np.zeros(len(n_points), np.int64)
        sizes[n_points > 0] = left
        out = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), points.filter(pa.array(keep)))
        out = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_rings))), pa.int32()), out)
        null = pa.array(~geoms.is_valid().to_numpy(zero_copy_only=False))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_parts))), pa.int32()), out, mask=null).cast(geoms.type)

    while True:
        _, k, far = farthest()
        if not (far > tolerance).any():
            break
        keep[k[far > tolerance]] = True
    was = np.array([v is True for v in valid(geoms)], bool)
    while True:
        new = built()
        ok, crossed = judged(new)
        at, k, far = farthest()
        hides = far >= 0
        e = edges_of(new)
        flat = np.bincount(e.ring, minlength=len(n_points))[n_points > 0] < 3
        flat |= e.area[n_points > 0] == 0
        spoilt = was & np.array([v is False for v in ok], bool)
        of_line = geom[ring[at]]
        meets = np.zeros(len(at), bool)
        ends = np.zeros(len(x), bool)
        ends[first + size - 1] = True
        meets[~ends[at]] = crossed
        named = np.bincount(of_line[meets & hides], minlength=len(n_parts)) > 0
        again = hides & (flat[ring[at]] | (spoilt[of_line] & (meets | ~named[of_line])))
        if not again.any():
            return new
        keep[k[again]] = True


def _first_of_largest(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each run of values, from one start to the next, the place of its largest, the first of equal ones."""
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(values))))
    top = np.flatnonzero(values >= np.maximum.reduceat(values, starts)[run])
    return top[np.searchsorted(run[top], np.arange(len(starts)))]


def _inside(e: Edges, ring: slice, x: np.ndarray, y: np.ndarray) -> bool | None:
    """Whether points lie inside a ring, by the first of them that isn't on its border; None if all are."""
    x1, y1, x2, y2 = e.x1[ring], e.y1[ring], e.x2[ring], e.y2[ring]
    for px, py in zip(x, y):
        on = ((x2 - x1) * (py - y1) == (y2 - y1) * (px - x1)) & (np.minimum(x1, x2) <= px) & (px <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= py) & (py <= np.maximum(y1, y2))
        if not on.any():
            up = (y1 <= py) != (y2 <= py)
            return bool((px < x1[up] + (py - y1[up]) * (x2[up] - x1[up]) / (y2[up] - y1[up])).sum() % 2)
    return None


def _inside_splits(e: Edges, parts: np.ndarray) -> np.ndarray:
    """A mask of the parts, whose rings touch each other, with an inside that isn't one."""
    own = np.flatnonzero(np.isin(e.part[e.ring], parts))
    group = np.searchsorted(parts, e.part[e.ring[own]])
    # Shells count up and holes down, whichever way they run.
    weight = e.sign[own].astype(np.int64)[:, None]
    found = planar.regions(group, np.column_stack((e.x1[own], e.y1[own], e.x2[own], e.y2[own])), weight, lambda w: w[:, 0] > 0, len(parts))
    return np.array([len(polygons) != 1 for polygons in found], bool)


def _nested(e: Edges, g: int) -> bool:
    """Whether the rings of a geometry, none across another, lie in each other as they should."""
    edges = slice(int(e.start[g]), int(e.start[g + 1]))
    numbers = np.unique(e.ring[edges])
    where = {int(r): slice(*np.searchsorted(e.ring, [r, r + 1]).tolist()) for r in numbers}
    # Corners and middles of edges: rings that share all corners still differ in these.
    points = {r: (np.concatenate((e.x1[s], (e.x1[s] + e.x2[s]) / 2)), np.concatenate((e.y1[s], (e.y1[s] + e.y2[s]) / 2))) for r, s in where.items()}
    shells = {int(e.part[r]): int(r) for r in numbers if e.shell[r]}
    holes = {p: [int(r) for r in numbers if e.part[r] == p and not e.shell[r]] for p in shells}
    for p, own in holes.items():
        for h in own:
            if not _inside(e, where[shells[p]], *points[h]):
                return False
            if any(_inside(e, where[o], *points[h]) is not False for o in own if o != h):
                return False
        for q, other in shells.items():
            if q != p and _inside(e, where[shells[p]], *points[other]) is not False:
                # In another part's shell, but then in one of its holes.
                if not any(_inside(e, where[h], *points[other]) for h in own):
                    return False
    return True
