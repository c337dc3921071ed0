"""Regions of the plane from edges that cross: a planar graph is built, its faces are walked, some are kept.

Edges carry weights: how often rings run along them, one column for each kind of ring.  They are cut wherever they
meet (pairs come from ``edge_pairs``), what runs along a piece is summed, and pieces along which as much
runs one way as the other (spikes, bridges, borders that two parts share) fall out.  Around each face runs a cycle
of half-edges with the face on its left; the winding numbers of neighbouring faces differ by the weight of the edge
between them, so one walk over the faces gives them all.  Rings are the borders between faces that are kept and
faces that aren't.

All shapes of a batch go through one graph: edges carry the number of their group, and nothing of one group meets another.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from .edge_pairs import near_pairs

Rings = list[list[np.ndarray]]


def _summed(group: np.ndarray, xy: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (rows x1, y1, x2, y2) by group, from their smaller to their larger end, each once, with the sum of what runs along it; none without."""
    back = (xy[:, 0] > xy[:, 2]) | ((xy[:, 0] == xy[:, 2]) & (xy[:, 1] > xy[:, 3]))
    xy = np.where(back[:, None], xy[:, [2, 3, 0, 1]], xy)
    weights = np.where(back[:, None], -weights, weights)
    order = np.lexsort((*xy.T[::-1], group))
    group, xy, weights = group[order], xy[order], weights[order]
    new = np.ones(len(xy), bool)
    new[1:] = (xy[1:] != xy[:-1]).any(axis=1) | (group[1:] != group[:-1])
    first = np.flatnonzero(new)
    total = np.add.reduceat(weights, first, axis=0) if len(xy) else weights
    group, xy = group[first], xy[first]
    stay = (total != 0).any(axis=1) & ((xy[:, 0] != xy[:, 2]) | (xy[:, 1] != xy[:, 3]))
    return group[stay], xy[stay], total[stay]


def _meetings(group: np.ndarray, xy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where edges are to be cut: the numbers of the edges, and points on them that aren't their ends."""
    x1, y1, x2, y2 = xy.T
    edge, point = [np.zeros(0, np.int64)], [np.zeros((0, 2))]

    def side(i, x, y):
        return np.sign((x2[i] - x1[i]) * (y - y1[i]) - (y2[i] - y1[i]) * (x - x1[i]))

    def add(i, x, y):
        inner = ~(((x == x1[i]) & (y == y1[i])) | ((x == x2[i]) & (y == y2[i])))
        edge.append(i[inner])
        point.append(np.column_stack((x, y))[inner])

    for i, j in near_pairs(group, x1, y1, x2, y2):
        s = [side(j, x1[i], y1[i]), side(j, x2[i], y2[i]), side(i, x1[j], y1[j]), side(i, x2[j], y2[j])]
        p = np.flatnonzero((s[0] * s[1] < 0) & (s[2] * s[3] < 0))
        a, b = i[p], j[p]
        dx, dy, ex, ey = x2[a] - x1[a], y2[a] - y1[a], x2[b] - x1[b], y2[b] - y1[b]
        t = ((x1[b] - x1[a]) * ey - (y1[b] - y1[a]) * ex) / (dx * ey - dy * ex)
        # Rounded into the boxes of both: on an edge along an axis a crossing has exactly its coordinate.
        x = np.clip(x1[a] + t * dx, np.maximum(x1[a], x1[b]), np.minimum(x2[a], x2[b]))
        (al, ah), (bl, bh) = (np.sort((y1[k], y2[k]), axis=0) for k in (a, b))
        y = np.clip(y1[a] + t * dy, np.maximum(al, bl), np.minimum(ah, bh))
        for k in (a, b):
            add(k, x, y)
        for on, at, (x, y) in ((j, s[0], (x1[i], y1[i])), (j, s[1], (x2[i], y2[i])), (i, s[2], (x1[j], y1[j])), (i, s[3], (x2[j], y2[j]))):
            # An edge runs from its smaller x to its larger.
            p = np.flatnonzero((at == 0) & (x1[on] <= x) & (x <= x2[on]) & (np.minimum(y1[on], y2[on]) <= y) & (y <= np.maximum(y1[on], y2[on])))
            add(on[p], x[p], y[p])
    return np.concatenate(edge), np.concatenate(point)


def cut(group: np.ndarray, xy: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same lines, by group, in pieces that meet at their ends alone, and their weights.

    A crossing is rounded to the nearest point there is, which may lead a piece across another: groups are cut again
    until nothing meets in them.
    """
    group, xy, weights = _summed(group, xy, weights)
    done = []
    while len(xy):
        edge, point = _meetings(group, xy)
        met = np.isin(group, group[edge])
        done.append((group[~met], xy[~met], weights[~met]))
        n = len(xy)
        of = np.concatenate((np.arange(n), edge, np.arange(n)))
        points = np.concatenate((xy[:, :2], point, xy[:, 2:]))
        open_ = met[of]
        of, points = of[open_], points[open_]
        # Along an edge x doesn't fall, and where it stays the same y goes from one end to the other.
        order = np.lexsort((points[:, 1] * np.where(xy[of, 3] < xy[of, 1], -1, 1), points[:, 0], of))
        of, points = of[order], points[order]
        same = of[1:] == of[:-1]
        piece = of[1:][same]
        group, xy, weights = _summed(group[piece], np.hstack((points[:-1], points[1:]))[same], weights[piece])
    done.append((group, xy, weights))
    group, xy, weights = (np.concatenate(column) for column in zip(*done))
    order = np.argsort(group, kind="stable")
    return group[order], xy[order], weights[order]


class _Sets:
    """Disjoint sets of numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = a = up[up[a]]
        return a

    def join(self, a: int, b: int) -> None:
        self.up[self.find(a)] = self.find(b)


def _faces(after: list[int]) -> list[int]:
    """The number of the cycle that each half-edge is in."""
    face, n = [-1] * len(after), 0
    for h in range(len(after)):
        if face[h] < 0:
            while face[h] < 0:
                face[h] = n
                h = after[h]
            n += 1
    return face


def region(xy: np.ndarray, weights: np.ndarray, keep: Callable[[np.ndarray], np.ndarray]) -> Rings:
    """Polygons of one group of edges (see regions)."""
    return regions(np.zeros(len(xy), np.int64), xy, np.reshape(weights, (len(xy), 1)), keep, 1)[0]


def regions(group: np.ndarray, xy: np.ndarray, weights: np.ndarray, keep: Callable[[np.ndarray], np.ndarray], n_groups: int) -> list[Rings]:
    """For each group the polygons (a shell counter-clockwise, then holes clockwise, closed) of the faces whose winding numbers ``keep`` takes.

    ``xy``: closed chains of directed edges in rows x1, y1, x2, y2; ``weights``: a row of integers for each.  ``keep`` doesn't take 0.
    """
    polygons: list[Rings] = [[] for _ in range(n_groups)]
    group, xy, weights = cut(np.asarray(group, np.int64), np.asarray(xy, float).reshape(-1, 4), weights)
    m = len(xy)
    if not m:
        return polygons
    # Half-edge 2e runs along edge e, 2e + 1 against it.
    origin = np.concatenate((xy[:, :2], xy[:, 2:]), axis=1).reshape(-1, 2)
    nodes, node, group_of_node = _nodes(np.repeat(group, 2), origin)
    step = np.concatenate((xy[:, 2:] - xy[:, :2], xy[:, :2] - xy[:, 2:]), axis=1).reshape(-1, 2)
    around = np.lexsort((np.arctan2(step[:, 1], step[:, 0]), node))
    place = np.empty(2 * m, np.int64)
    place[around] = np.arange(2 * m)
    first = np.searchsorted(node[around], node, side="left")
    last = np.searchsorted(node[around], node, side="right") - 1
    # After h comes, clockwise from its twin, the next half-edge out of the node that h ends in.
    clockwise = around[np.where(place == first, last, place - 1)]
    after = clockwise[np.arange(2 * m) ^ 1].tolist()
    face = _faces(after)
    n_faces = max(face) + 1
    labels = np.array(face)
    ends = nodes[node] - nodes[np.searchsorted(group_of_node, np.repeat(group, 2))]  # from the first node of the group
    others = ends[np.arange(2 * m) ^ 1]
    area = np.bincount(labels, ends[:, 0] * others[:, 1] - others[:, 0] * ends[:, 1], n_faces)
    # Faces that are one: the outside of a connected piece, and the face of another piece that it lies in.  n_faces is the outside of all.
    pieces = _Sets(len(nodes))
    for a, b in zip(node[0::2].tolist(), node[1::2].tolist()):
        pieces.join(a, b)
    piece = np.array([pieces.find(a) for a in range(len(nodes))])
    one = _Sets(n_faces + 1)
    piece_of_face = np.empty(n_faces, np.int64)
    piece_of_face[labels] = piece[node]
    low, high = np.minimum(xy[:, 1], xy[:, 3]), np.maximum(xy[:, 1], xy[:, 3])
    roots, starts = np.unique(piece, return_index=True)  # nodes are sorted: the first is the leftmost
    whole = np.lexsort((area, piece_of_face))
    outside = whole[np.searchsorted(piece_of_face[whole], roots)]  # the one face of a piece with an area below zero
    of = group_of_node[starts]
    begin, end = np.searchsorted(group, of), np.searchsorted(group, of, side="right")
    alone = np.bincount(of, minlength=n_groups)[of] == 1
    for out in outside[alone].tolist():
        one.join(out, n_faces)
    for root, start, out, b, e in np.column_stack((roots, starts, outside, begin, end))[~alone].tolist():
        x, y = nodes[start]
        near = b + np.flatnonzero((low[b:e] <= y) & (y < high[b:e]) & (piece[node[2 * b : 2 * e : 2]] != root))
        slope = (xy[near, 2] - xy[near, 0]) / (xy[near, 3] - xy[near, 1])
        at = xy[near, 0] + (y - xy[near, 1]) * slope
        near, at, slope = near[at < x], at[at < x], slope[at < x]
        if len(near):
            k = int(near[np.lexsort((slope, at))[-1]])
            one.join(out, face[2 * k + int(xy[k, 3] > xy[k, 1])])  # the half-edge that runs down has it on its left
        else:
            one.join(out, n_faces)
    root_of = np.array([one.find(f) for f in range(n_faces + 1)])
    left, right = root_of[labels[0::2]], root_of[labels[1::2]]
    kept = keep(_windings(left, right, weights, n_faces + 1, int(root_of[n_faces])))
    left_kept, right_kept = kept[left], kept[right]
    border = np.empty(2 * m, bool)
    border[0::2], border[1::2] = left_kept & ~right_kept, right_kept & ~left_kept
    for a, b in zip(left[left_kept & right_kept].tolist(), right[left_kept & right_kept].tolist()):
        one.join(a, b)
    out: dict[int, list[np.ndarray]] = {}
    for ring, h in _rings(after, border.tolist(), node.tolist()):
        out.setdefault(one.find(face[h]), []).append(ring)
    for rings in out.values():
        found = [nodes[r] for r in rings]
        polygons[int(group_of_node[rings[0][0]])].append(sorted(found, key=lambda r: _double_area(r) < 0) if len(found) > 1 else found)
    return polygons


def _nodes(group: np.ndarray, xy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different points of each group, sorted by group, x and y; the number of each row's point; and each point's group."""
    order = np.lexsort((xy[:, 1], xy[:, 0], group))
    g, p = group[order], xy[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]).any(axis=1) | (g[1:] != g[:-1])
    node = np.empty(len(p), np.int64)
    node[order] = np.cumsum(new) - 1
    return p[new], node, g[new]


def _windings(left: np.ndarray, right: np.ndarray, weights: np.ndarray, n: int, outside: int) -> np.ndarray:
    """Winding numbers of all faces, from that outside all rings, which is 0."""
    beside = np.concatenate((left, right))
    order = np.argsort(beside, kind="stable")
    start = np.searchsorted(beside[order], np.arange(n + 1)).tolist()
    other = np.concatenate((right, left))[order].tolist()
    gain = np.concatenate((-weights, weights))[order]
    out = np.zeros((n, weights.shape[1]), np.int64)
    seen, todo = [False] * n, [outside]
    seen[outside] = True
    for f in todo:
        for k in range(start[f], start[f + 1]):
            g = other[k]
            if not seen[g]:
                seen[g] = True
                out[g] = out[f] + gain[k]
                todo.append(g)
    return out


def _rings(after: list[int], border: list[bool], node: list[int]):
    """Simple closed rings of node numbers along half-edges of the border, each with one of its half-edges."""
    done = [False] * len(after)
    for start in range(len(after)):
        if not border[start] or done[start]:
            continue
        path, at, h = [], {}, start
        while not done[h]:
            done[h] = True
            at[node[h]] = len(path)
            path.append(h)
            h = after[h]
            while not border[h]:
                h = after[h ^ 1]
            if node[h] in at:  # a ring is closed here; what led to it goes on
                k = at[node[h]]
                ring = path[k:]
                del path[k:]
                for g in ring:
                    del at[node[g]]
                low = min(range(len(ring)), key=lambda i: node[ring[i]])
                numbers = [node[g] for g in ring[low:] + ring[:low]]
                yield [*numbers, numbers[0]], ring[0]


def _double_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum())


def _edges(ring: np.ndarray) -> np.ndarray:
    closed = np.concatenate((ring, ring[:1]))  # an edge without length falls out
    return np.hstack((closed[:-1], closed[1:]))


def of_rings(rings: list[np.ndarray], group: list[int], kind: list[int], n_groups: int, keep: Callable[[np.ndarray], np.ndarray]) -> list[Rings]:
    """The region of each group of rings, of several kinds: column k of the winding numbers counts the rings of kind k."""
    edges = [_edges(r) for r in rings]
    size = [len(e) for e in edges]
    if not edges:
        return [[] for _ in range(n_groups)]
    weights = np.eye(max(kind) + 1, dtype=np.int64)[np.repeat(kind, size)]
    return regions(np.repeat(group, size), np.concatenate(edges), weights, keep, n_groups)


def unions(shapes: list[Rings]) -> list[Rings]:
    """What the polygons of each shape, shells counter-clockwise and holes clockwise, cover together; a shape of one polygon as it is."""
    several = [k for k, polygons in enumerate(shapes) if len(polygons) > 1]
    flat = [(r, k) for k in several for rings in shapes[k] for r in rings if len(r) > 2]
    found = of_rings([r for r, _ in flat], [k for _, k in flat], [0] * len(flat), len(shapes), lambda w: w[:, 0] > 0)
    return [found[k] if len(polygons) > 1 else polygons for k, polygons in enumerate(shapes)]


def oriented(polygons: Rings) -> Rings:
    """Rings in their right direction: shells counter-clockwise, holes clockwise."""
    return [[r if (_double_area(r) > 0) == (i == 0) else r[::-1] for i, r in enumerate(rings)] for rings in polygons]


def arrays(geoms: pa.Array) -> list[Rings]:
    """Each geometry (parts, rings, points with x and y) as arrays of coordinates; a null one has no parts."""

    def cuts(lists: pa.Array) -> list[int]:
        return np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64).tolist()

    parts = geoms.flatten()
    rings = parts.flatten()
    points = rings.flatten()
    xy = np.column_stack([points.field(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in (0, 1)]).astype(float)
    flat: list = xy
    for level in (rings, parts, geoms):
        at = cuts(level)
        flat = [flat[a:b] for a, b in zip(at[:-1], at[1:])]
    return flat


def geometries(shapes: list[Rings], kind: pa.DataType) -> pa.Array:
    """The shapes as an Arrow array, null where there is no polygon."""
    rings = [r for polygons in shapes for p in polygons for r in p]
    ends = lambda sizes: pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
    xy = np.concatenate([np.zeros((0, 2)), *rings])
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"])
    out = pa.ListArray.from_arrays(ends([len(r) for r in rings]), points)
    out = pa.ListArray.from_arrays(ends([len(p) for polygons in shapes for p in polygons]), out)
    return pa.ListArray.from_arrays(ends([len(polygons) for polygons in shapes]), out, mask=pa.array([not p for p in shapes], pa.bool_())).cast(kind)


def covered_areas(geoms: pa.Array) -> list[float | None]:
    """Area that the (valid) parts of each geometry cover, what several cover counted once."""
    shapes = [oriented([[r for r in rings if len(r) > 2] for rings in polygons]) for polygons in arrays(geoms)]
    areas = [sum(_double_area(r) for rings in polygons for r in rings) / 2 for polygons in unions(shapes)]
    return [a if known else None for a, known in zip(areas, geoms.is_valid().to_pylist())]


def repaired(shapes: list[Rings]) -> list[Rings]:
    """Valid polygons of what the rings of each part go round, its holes left out, and of all parts of a shape together.

    A ring goes round what it winds round in sum: where its loops overlap in one direction they count once, where they
    run in opposite directions they cancel.  Rings with a point that isn't finite are left out, and with a shell its holes.
    """
    parts = [(k, rings) for k, polygons in enumerate(shapes) for rings in polygons if rings and np.isfinite(rings[0]).all()]
    rings = [(p, i > 0, r) for p, (_, own) in enumerate(parts) for i, r in enumerate(own) if i == 0 or np.isfinite(r).all()]
    n = len(rings)
    around = of_rings([r for _, _, r in rings], list(range(n)), [0] * n, n, lambda w: w[:, 0] != 0)
    shell: list[Rings] = [[] for _ in parts]
    holes: list[Rings] = [[] for _ in parts]
    for (p, hole, _), found in zip(rings, around):
        (holes if hole else shell)[p] += found
    pierced = [p for p in range(len(parts)) if holes[p]]
    flat = [(r, p, kind) for p in pierced for kind, of in enumerate((shell, holes)) for polygon in of[p] for r in polygon]
    left = of_rings(*([f[i] for f in flat] for i in range(3)), len(parts), lambda w: (w[:, 0] > 0) & (w[:, 1] == 0))
    for p in pierced:
        shell[p] = left[p]
    out: list[Rings] = [[] for _ in shapes]
    several = np.bincount([k for k, own in parts], minlength=len(shapes)) > 1
    for (k, _), found in zip(parts, shell):
        out[k] += found
    return [whole if many else own for own, whole, many in zip(out, unions([o if m else [] for o, m in zip(out, several)]), several)]
