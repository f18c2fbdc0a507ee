"""Exact measures of two shapes, one pair at a time: what cells must add up to."""

from __future__ import annotations

import math

import numpy as np

from landrank.operators.geometry import EARTH_M


def polygons(rings: list) -> list[list]:
    """Rings as polygons, outer ring first: the first and every clockwise ring is outer, others are holes of the last
    outer one; rings under four points are dropped and open ones closed."""
    out: list[list] = []
    for ring in rings:
        r = [list(map(float, p[:2])) for p in ring]
        if r and r[0] != r[-1]:
            r.append(r[0])
        if len(r) < 4:
            continue
        p = np.array(r)
        area = float(np.sum(p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1])) / 2
        if not out or area < 0:
            out.append([r])
        else:
            out[-1].append(r)
    return out


def _local(points, origin: tuple[float, float]) -> np.ndarray:
    """Metres east and north of the origin."""
    p = np.asarray(points, np.float64).reshape(-1, 2)
    k = math.pi / 180 * EARTH_M
    return np.stack([(p[:, 0] - origin[0]) * k * math.cos(math.radians(origin[1])), (p[:, 1] - origin[1]) * k], axis=1)


def contains(parts: list[list[np.ndarray]], points: np.ndarray) -> np.ndarray:
    """Whether points lie in polygons (even-odd over each polygon's rings)."""
    hit = np.zeros(len(points), bool)
    for rings in parts:
        odd = np.zeros(len(points), bool)
        for r in rings:
            a, b = r[:-1], r[1:]
            x, y = points[:, :1], points[:, 1:]
            cross = (a[:, 1] > y) != (b[:, 1] > y)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
            odd ^= (np.sum(cross & (x < at), axis=1) % 2).astype(bool)
        hit |= odd
    return hit


def _cuts(p: np.ndarray, q: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where segment p-q meets segments a-b, as parts of its length."""
    d, e = q - p, b - a
    den = d[0] * e[:, 1] - d[1] * e[:, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = ((a[:, 0] - p[0]) * e[:, 1] - (a[:, 1] - p[1]) * e[:, 0]) / den
        u = ((a[:, 0] - p[0]) * d[1] - (a[:, 1] - p[1]) * d[0]) / den
    return t[(den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)]


def _segment_distance(points: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 256) -> float:
    """Least distance of points from segments, a block of points against all segments at a time."""
    d = b - a
    n = np.maximum((d * d).sum(1), 1e-18)
    best = math.inf
    for at in range(0, len(points), block):
        p = points[at:at + block, None]
        t = np.clip(((p - a) * d).sum(2) / n, 0, 1)
        best = min(best, float(np.sqrt((((a + t[:, :, None] * d) - p) ** 2).sum(2)).min()))
    return best


def _edges(shape: list[list], origin: tuple[float, float]) -> tuple[list[list[np.ndarray]], np.ndarray, np.ndarray]:
    """Polygons in metres from the origin, and where all their edges begin and end."""
    parts = [[_local(r, origin) for r in rs] for rs in shape]
    return parts, np.concatenate([r[:-1] for rs in parts for r in rs]), np.concatenate([r[1:] for rs in parts for r in rs])


def _spans(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """At each x the sorted heights at which edges cross it."""
    low, high = np.minimum(a[:, 0], b[:, 0]), np.maximum(a[:, 0], b[:, 0])
    out = []
    for v in x:
        on = (low <= v) & (v < high)
        p, q = a[on], b[on]
        out.append(np.sort(p[:, 1] + (v - p[:, 0]) * (q[:, 1] - p[:, 1]) / (q[:, 0] - p[:, 0])))
    return out


def overlap_area(rings: list, other: list) -> float:
    """Square metres that two polygons of any form, with holes and parts, share; 0 where either is no area.

    The plane is cut into strips at all corners and crossings; within a strip no edges cross, so the shared height in its
    middle times its width is its area.  Edges outside of the common box are left out first.
    """
    one, two = polygons(rings), polygons(other)
    if not one or not two:
        return 0.0
    origin = tuple(one[0][0][0])
    sides = [_edges(s, origin)[1:] for s in (one, two)]
    low = max(min(a[:, 0].min(), b[:, 0].min()) for a, b in sides)
    high = min(max(a[:, 0].max(), b[:, 0].max()) for a, b in sides)
    if low >= high:
        return 0.0
    near = [(a[k], b[k]) for a, b in sides for k in [(np.minimum(a[:, 0], b[:, 0]) < high) & (np.maximum(a[:, 0], b[:, 0]) > low)]]
    (a, b), (c, d) = near
    x = [low, high, *a[:, 0], *b[:, 0], *c[:, 0], *d[:, 0]]
    for p, q in zip(a, b, strict=True):
        close = (np.minimum(c[:, 1], d[:, 1]) <= max(p[1], q[1])) & (np.maximum(c[:, 1], d[:, 1]) >= min(p[1], q[1]))
        t = _cuts(p, q, c[close], d[close])
        x += (p[0] + t * (q[0] - p[0])).tolist()
    x = np.unique(np.clip(x, low, high))
    middle, width = (x[1:] + x[:-1]) / 2, np.diff(x)
    area = 0.0
    for w, ys, zs in zip(width, _spans(a, b, middle), _spans(c, d, middle), strict=True):
        n, m = len(ys) // 2 * 2, len(zs) // 2 * 2
        shared = np.minimum(ys[1:n:2, None], zs[1:m:2]) - np.maximum(ys[0:n:2, None], zs[0:m:2])
        area += w * float(np.maximum(shared, 0).sum())
    return area


def polygon_distance(rings: list, other: list) -> float:
    """Least distance of two polygons in metres; 0 if they meet or one holds the other."""
    one, two = polygons(rings), polygons(other)
    if not one or not two:
        return math.inf
    origin = tuple(one[0][0][0])
    (p, a, b), (q, c, d) = _edges(one, origin), _edges(two, origin)
    if contains(p, c).any() or contains(q, a).any():
        return 0.0
    for s, e in zip(a, b, strict=True):
        near = (np.minimum(c, d) <= np.maximum(s, e)).all(1) & (np.maximum(c, d) >= np.minimum(s, e)).all(1)
        if near.any() and len(_cuts(s, e, c[near], d[near])):
            return 0.0
    return min(_segment_distance(a, c, d), _segment_distance(c, a, b))


def measures(rings: list, lines: list) -> tuple[float, float]:
    """(metres of the lines inside the polygon, least distance of the lines from it; 0 if they meet)."""
    shape = polygons(rings)
    lines = [x for x in lines if len(x) >= 2]
    if not shape or not lines:
        return 0.0, math.inf
    origin = tuple(shape[0][0][0])
    parts, a, b = _edges(shape, origin)
    low, high = np.minimum(a, b).min(0), np.maximum(a, b).max(0)
    length, distance = 0.0, math.inf
    for line in lines:
        xy = _local(line, origin)
        near = (np.minimum(xy[:-1], xy[1:]) <= high).all(1) & (np.maximum(xy[:-1], xy[1:]) >= low).all(1)  # others are outside
        for p, q in zip(xy[:-1][near], xy[1:][near], strict=True):
            t = np.unique(np.concatenate([[0.0, 1.0], _cuts(p, q, a, b)]))
            middle = p + ((t[:-1] + t[1:]) / 2)[:, None] * (q - p)
            # a piece between two crossings is inside if its middle is
            length += float(((t[1:] - t[:-1]) * contains(parts, middle)).sum() * np.hypot(*(q - p)))
            if len(t) > 2:
                distance = 0.0
        if distance and contains(parts, xy).any():
            distance = 0.0
        if distance:
            distance = min(distance, _segment_distance(np.concatenate([a, b]), xy[:-1], xy[1:]), _segment_distance(xy, a, b))
    return length, distance
