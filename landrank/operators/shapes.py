"""Polygons and lines measured against each other cell by cell.

Each shape is cut to the cells that it touches, features to a skirt around them as well, so a shape travels once a cell
and a long river or a large zone only as far as parcels are near.  Cells are as small as parcels are dense.  What lies in a cell is
measured by numpy: lengths and areas add up over cells, distances are the least of them.  Equal shapes are measured once (kinds()).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landrank.operators.geometry import DEGREE_M, EARTH_M, RADIUS_M, expanded
from landrank.operators.geometry import overlap as boxes_meet
from landrank.session import checkpointed

#: Side of a tile in degrees: the earth has 101,250, and of each some 270 bytes are known, so tiles can be broadcast.
TILE = 0.8
#: Halvings of a tile's sides to its blocks, and to its smallest cells (some 350 m); each block has cells of its own size.
BLOCKS, FINEST = 4, 8
#: Parcels in a cell, about; pieces of a cell that one task takes before the cell is dealt over several.
HELD, CHUNK = 256, 4096
HOT_SHARE = 1000
#: Kinds of equal shapes, some 100 bytes each, that every task may know.
FEW = 100_000
METRES = math.pi / 180 * EARTH_M
#: Metres around a cell to which shapes are cut; a bit over the search radius, as degrees are taken as somewhat longer there.
SKIRT = RADIUS_M * 1.02
CELL = ["k", "cx", "cy"]
_PIECE = "id long, x0 double, y0 double, x1 double, y1 double, ox double, oy double, xy array<double>, sizes array<int>, areas int, k int, cx long, cy long"
_MEASURE = "left_id long, right_id long, inside_m double, line_m double, overlap_m2 double, area_m double"


# -- cutting ---------------------------------------------------------------------------------------------------------

def clipped(ring: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """A ring (n x 2, open or closed) cut to a box (x0, y0, x1, y1), closed; empty if nothing is left.

    Parts that the box divides stay tied by edges on its border, so that insides are told right by the even-odd rule.
    """
    p = ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring
    for axis, bound, sign in ((0, box[0], 1), (0, box[2], -1), (1, box[1], 1), (1, box[3], -1)):
        if not len(p):
            break
        off = sign * (p[:, axis] - bound)
        if (off >= 0).all():
            continue
        q, next_off = np.roll(p, -1, axis=0), np.roll(off, -1)
        cross = (off < 0) & (next_off > 0) | (off > 0) & (next_off < 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            at = np.where(cross[:, None], p + (off / (off - next_off))[:, None] * (q - p), p)
        at[:, axis] = bound
        p = np.stack([p, at], axis=1).reshape(-1, 2)[np.stack([off >= 0, cross], axis=1).reshape(-1)]
    return np.concatenate([p, p[:1]]) if len(p) >= 3 else np.empty((0, 2))


def clipped_rings(rings: list[np.ndarray], box: tuple) -> list[np.ndarray]:
    """Rings of a polygon with holes and parts, each cut to a box; what is empty or no area there goes.

    A ring with a coordinate that is not finite cannot be cut and stays as it is: slower, but nothing is lost.
    """
    out = []
    for r in rings:
        c = clipped(r, box) if np.isfinite(r).all() else r
        if len(c) >= 4 and (c.min(0) < c.max(0)).all() or not np.isfinite(r).all():
            out.append(c)
    return out


def clipped_line(line: np.ndarray, box: tuple) -> list[np.ndarray]:
    """The runs of a line (n x 2) that lie in a box."""
    if not np.isfinite(line).all():
        return [line]
    p, d = line[:-1], np.diff(line, axis=0)
    t0, t1 = np.zeros(len(p)), np.ones(len(p))
    for axis, low, high in ((0, box[0], box[2]), (1, box[1], box[3])):
        with np.errstate(divide="ignore", invalid="ignore"):
            a, b = (low - p[:, axis]) / d[:, axis], (high - p[:, axis]) / d[:, axis]
        flat = d[:, axis] == 0
        out = flat & ((p[:, axis] < low) | (p[:, axis] > high))
        t0 = np.where(out, 2.0, np.where(flat, t0, np.maximum(t0, np.minimum(a, b))))
        t1 = np.where(flat, t1, np.minimum(t1, np.maximum(a, b)))
    keep = np.flatnonzero(t0 <= t1)
    starts, ends = p[keep] + t0[keep, None] * d[keep], p[keep] + t1[keep, None] * d[keep]
    runs: list[list] = []
    for n, i in enumerate(keep):
        if runs and t0[i] == 0 and keep[n - 1] == i - 1 and t1[i - 1] == 1:
            runs[-1].append(ends[n])
        else:
            runs.append([starts[n], ends[n]])
    return [np.array(r) for r in runs]


# -- measures in a cell ----------------------------------------------------------------------------------------------
#
# All pairs of a cell are measured together: arrays have a row for each edge of a left and each edge of a right that a pair
# brings together, and sums, minima and parities are taken by pair.

def products(n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each k all combinations of 0..n[k]-1 and 0..m[k]-1: k, the first, the second."""
    count = n * m
    k = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)
    return k, at // m[k], at % m[k]


def cross(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]


def crossings(p: np.ndarray, q: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row by row: where on p-q it meets a-b, and whether it does."""
    d, e, g = q - p, b - a, a - p
    den = cross(d, e)
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = cross(g, e) / den, cross(g, d) / den
    return t, (den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)


def below(point: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row whether a ray from the point to the right meets the edge a-b: an odd number of them means inside."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return ((a[:, 1] > point[:, 1]) != (b[:, 1] > point[:, 1])) & (point[:, 0] < a[:, 0] + (point[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1]))


def odd(group: np.ndarray, n: int, hit: np.ndarray) -> np.ndarray:
    return np.bincount(group[hit], minlength=n) % 2 == 1


def gap(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row the distance of a point from the segment a-b."""
    d = b - a
    t = np.clip(((p - a) * d).sum(1) / np.maximum((d * d).sum(1), 1e-18), 0, 1)
    return np.hypot(*(a + t[:, None] * d - p).T)


class Meeting:
    """Pairs (i, j) of lefts and rights, brought together edge by edge, in degrees (dp...) and in metres from the left's origin."""

    def __init__(self, left: Pieces, i: np.ndarray, j: np.ndarray, right: tuple):
        self.n = len(i)
        a, b, real, starts = left.a, left.b, left.real, left.starts
        p, q, solid, firsts = right
        self.ne, self.ns = starts[i + 1] - starts[i], firsts[j + 1] - firsts[j]
        self.origin = left.origin[i]
        self.scale = METRES * np.stack([np.cos(np.radians(self.origin[:, 1])), np.ones(self.n)], axis=1)
        self.pair, e, s = products(self.ne, self.ns)
        #: numbers of a pair's left edges and right edges
        self.e0, self.s0 = np.cumsum(self.ne) - self.ne, np.cumsum(self.ns) - self.ns
        self.e, self.s = self.e0[self.pair] + e, self.s0[self.pair] + s
        at, to = starts[i][self.pair] + e, firsts[j][self.pair] + s
        self.ea, self.eb, self.real = a[at], b[at], real[at]
        self.sp, self.sq, self.solid = p[to], q[to], solid[to]
        self.a, self.b, self.p, self.q = (self.local(v, self.pair) for v in (self.ea, self.eb, self.sp, self.sq))
        self.t, self.meet = crossings(self.p, self.q, self.a, self.b)
        # an edge a row: of the pair's left, of the pair's right
        k, own = self.rows(self.ne)
        self.left_pair, self.left_a, self.left_b = k, a[starts[i][k] + own], b[starts[i][k] + own]
        k, own = self.rows(self.ns)
        self.right_pair, self.right_p, self.right_q = k, p[firsts[j][k] + own], q[firsts[j][k] + own]

    @staticmethod
    def rows(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.repeat(np.arange(len(n)), n)
        return k, np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)

    def local(self, v: np.ndarray, pair: np.ndarray) -> np.ndarray:
        return (v - self.origin[pair]) * self.scale[pair]

    def distances(self) -> np.ndarray:
        """Least distance of edges that are the shapes' own, 0 where they meet; inf where either has none here."""
        out, own = np.full(self.n, np.inf), self.real & self.solid
        a, b, p, q = self.a[own], self.b[own], self.p[own], self.q[own]
        np.minimum.at(out, self.pair[own], np.minimum(np.minimum(gap(p, a, b), gap(q, a, b)), np.minimum(gap(a, p, q), gap(b, p, q))))
        out[self.pair[own & self.meet]] = 0.0
        return out

    def in_left(self, points: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Whether points (in degrees, each of a pair) lie in the pair's left."""
        k, _, e = products(np.ones(len(pair), np.int64), self.ne[pair])
        e = self.e0[pair][k] + e
        return odd(k, len(pair), below(points[k], self.left_a[e], self.left_b[e]))

    def lengths(self, cell: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Metres of the rights' segments in the cell that lie in the left, and which pairs have any part inside."""
        n, every = len(self.right_pair), np.arange(len(self.right_pair))
        p, q = self.right_p, self.right_q
        seg, t = [every, every, self.s[self.meet]], [np.zeros(n), np.ones(n), self.t[self.meet]]
        for axis, bound in ((0, cell[0]), (0, cell[2]), (1, cell[1]), (1, cell[3])):
            with np.errstate(divide="ignore", invalid="ignore"):
                at = (bound - p[:, axis]) / (q[:, axis] - p[:, axis])
            on = np.flatnonzero((at > 0) & (at < 1))
            seg.append(on)
            t.append(at[on])
        seg, t = np.concatenate(seg), np.concatenate(t)
        order = np.lexsort((t, seg))
        seg, t = seg[order], t[order]
        part = (seg[1:] == seg[:-1]) & (t[1:] > t[:-1])
        seg, low, high = seg[:-1][part], t[:-1][part], t[1:][part]
        middle, pair = p[seg] + ((low + high) / 2)[:, None] * (q[seg] - p[seg]), self.right_pair[seg]
        held = self.in_left(middle, pair)
        here = held & (middle >= [cell[0], cell[1]]).all(1) & (middle < [cell[2], cell[3]]).all(1)
        size = (high - low) * np.hypot(*(self.local(q[seg], pair) - self.local(p[seg], pair)).T)
        return np.bincount(pair, size * here, self.n), np.bincount(pair[held], minlength=self.n) > 0

    def contained(self, cell: tuple) -> np.ndarray:
        """Whether a point of one area is in the other, for areas whose edges do not meet.

        Points of the shapes' own edges are tried, as others can lie in a hole; where a left has none, the middle of the cell.
        """
        out = np.zeros(self.n, bool)
        for points in (self.sp, self.sq, (self.sp + self.sq) / 2):
            inside = odd(self.s, len(self.right_pair), below(points, self.ea, self.eb) & self.solid)
            out[self.right_pair[inside]] = True
        for points in (self.ea, self.eb, (self.ea + self.eb) / 2):
            inside = odd(self.e, len(self.left_pair), below(points, self.sp, self.sq) & self.real)
            out[self.left_pair[inside]] = True
        bare = np.flatnonzero(np.bincount(self.pair, self.real, self.n) == 0)
        if len(bare):
            middle = np.tile([(cell[0] + cell[2]) / 2, (cell[1] + cell[3]) / 2], (len(bare), 1))
            k, _, s = products(np.ones(len(bare), np.int64), self.ns[bare])
            s = self.s0[bare][k] + s
            both = self.in_left(middle, bare) & odd(k, len(bare), below(middle[k], self.right_p[s], self.right_q[s]))
            out[bare[both]] = True
        return out

    def overlaps(self, cell: tuple) -> np.ndarray:
        """Square metres that two areas share in the cell.

        The plane is cut into strips at all corners and crossings; in the middle of a strip heights are sorted, and what
        lies between two of them is shared where both areas have been entered an odd number of times.
        """
        (lp, la, lb), (rp, ra, rb) = (self.left_pair, self.left_a, self.left_b), (self.right_pair, self.right_p, self.right_q)
        low, high = np.full(self.n, cell[0]), np.full(self.n, cell[2])
        for pair, a, b in ((lp, la, lb), (rp, ra, rb)):
            least, most = np.full(self.n, np.inf), np.full(self.n, -np.inf)
            np.minimum.at(least, pair, np.minimum(a[:, 0], b[:, 0]))
            np.maximum.at(most, pair, np.maximum(a[:, 0], b[:, 0]))
            low, high = np.maximum(low, least), np.minimum(high, most)
        m = self.meet
        pair, x = [np.arange(self.n), np.arange(self.n), lp, rp, self.pair[m]], [low, high, la[:, 0], ra[:, 0], self.sp[m, 0] + self.t[m] * (self.sq[m, 0] - self.sp[m, 0])]
        for k, a, b in ((lp, la, lb), (rp, ra, rb)):
            for y in (cell[1], cell[3]):
                on = (a[:, 1] < y) != (b[:, 1] < y)
                pair.append(k[on])
                x.append(a[on, 0] + (y - a[on, 1]) / (b[on, 1] - a[on, 1]) * (b[on, 0] - a[on, 0]))
        pair, x = np.concatenate(pair), np.concatenate(x)
        keep = (low < high)[pair]
        pair, x = pair[keep], np.clip(x[keep], low[pair[keep]], high[pair[keep]])
        order = np.lexsort((x, pair))
        pair, x = pair[order], x[order]
        part = (pair[1:] == pair[:-1]) & (x[1:] > x[:-1])
        strip, middle, width = pair[:-1][part], ((x[1:] + x[:-1]) / 2)[part], (x[1:] - x[:-1])[part]
        at, height, ours = [], [], []
        for n, first, a, b, own in ((self.ne, self.e0, la, lb, 1), (self.ns, self.s0, ra, rb, 0)):
            k, _, e = products(np.ones(len(strip), np.int64), n[strip])
            e = first[strip][k] + e
            on = (np.minimum(a[e, 0], b[e, 0]) <= middle[k]) & (middle[k] < np.maximum(a[e, 0], b[e, 0]))
            k, e = k[on], e[on]
            at.append(k)
            height.append(np.clip(a[e, 1] + (middle[k] - a[e, 0]) * (b[e, 1] - a[e, 1]) / (b[e, 0] - a[e, 0]), cell[1], cell[3]))
            ours.append(np.full(len(k), own))
        at, height, ours = np.concatenate(at), np.concatenate(height), np.concatenate(ours)
        order = np.lexsort((height, at))
        at, height, ours = at[order], height[order], ours[order]
        # edges close, so every strip is entered and left: counts before it are even
        both = (np.cumsum(ours) % 2 == 1) & (np.cumsum(1 - ours) % 2 == 1)
        shared = np.where(both[:-1] & (at[1:] == at[:-1]), np.diff(height), 0.0)
        degrees = np.bincount(strip[at[:-1]], shared * width[at[:-1]], self.n) if len(at) > 1 else np.zeros(self.n)
        return degrees * self.scale[:, 0] * self.scale[:, 1]


class Pieces:
    """The pieces of a cell as arrays: boxes and origins of their shapes, edges of areas and segments of lines with their owner."""

    def __init__(self, table: pa.Table, cut: tuple):
        col = lambda c: table[c].combine_chunks()
        self.id = col("id").to_numpy(zero_copy_only=False)
        self.box = np.stack([col(c).to_numpy(zero_copy_only=False) for c in ("x0", "y0", "x1", "y1")], axis=1) if len(self.id) else np.empty((0, 4))
        self.origin = np.stack([col("ox").to_numpy(zero_copy_only=False), col("oy").to_numpy(zero_copy_only=False)], axis=1)
        paths: dict[bool, list] = {True: [], False: []}
        for i, (xy, sizes, areas) in enumerate(zip(col("xy"), col("sizes").to_pylist(), col("areas").to_pylist(), strict=True)):
            at, points = 0, np.asarray(xy.values, np.float64).reshape(-1, 2)
            for n, size in enumerate(sizes):
                if size > 1:
                    paths[n < areas].append((points[at:at + size - 1], points[at + 1:at + size], np.full(size - 1, i)))
                at += size
        joined = lambda k, j: np.concatenate([p[j] for p in paths[k]]) if paths[k] else np.empty((0, 2)) if j < 2 else np.empty(0, np.int64)
        (self.a, self.b, self.of), (self.p, self.q, self.line_of) = ([joined(k, j) for j in range(3)] for k in (True, False))
        border = np.zeros(len(self.a), bool)
        for axis, bound in ((0, cut[0]), (0, cut[2]), (1, cut[1]), (1, cut[3])):
            border |= (self.a[:, axis] == bound) & (self.b[:, axis] == bound)
        self.real = ~border  # other edges are of the shape itself
        bounds = np.arange(len(self.id) + 1)
        self.starts, self.line_starts = np.searchsorted(self.of, bounds), np.searchsorted(self.line_of, bounds)

    def areas(self) -> tuple:
        return self.a, self.b, self.real, self.starts

    def lines(self) -> tuple:
        return self.p, self.q, np.ones(len(self.p), bool), self.line_starts


def measured_cell(left: Pieces, right: Pieces, cell: tuple, lines: bool, areas: bool, most: int = 1 << 20) -> Iterator[list]:
    """Columns of _MEASURE for all pairs whose boxes come within RADIUS_M, pairs of about `most` edges at a time.  Lefts are areas."""
    x0, y0, x1, y1 = (left.box[:, k, None] for k in range(4))
    u0, v0, u1, v1 = right.box.T
    dy = RADIUS_M / DEGREE_M
    dx = RADIUS_M / (DEGREE_M * np.maximum(0.1, np.cos(np.radians((y0 + y1) / 2))))
    sizes, others = np.diff(left.starts), np.diff(right.starts) + np.diff(right.line_starts)
    step = max(1, most // max(1, int(sizes.max(initial=1)) * int(others.sum())))
    for k in range(0, len(left.id), step):
        own = slice(k, k + step)
        near = (x0[own] - dx[own] <= u1) & (u0 <= x1[own] + dx[own]) & (y0[own] - dy <= v1) & (v0 <= y1[own] + dy) & (sizes[own, None] > 0)
        i, j = np.nonzero(near)
        i += k
        n = len(i)
        if not n:
            continue
        length, line_m, area, area_m = np.zeros(n), np.full(n, np.inf), np.zeros(n), np.full(n, np.inf)
        if lines:
            m = Meeting(left, i, j, right.lines())
            line_m = m.distances()
            length, within = m.lengths(cell)
            line_m[within] = 0.0
        if areas:
            m = Meeting(left, i, j, right.areas())
            area_m = m.distances()
            area_m[m.contained(cell)] = 0.0
            area = m.overlaps(cell)
        limit = lambda v: pa.array(v, mask=v > RADIUS_M)
        yield [pa.array(left.id[i]), pa.array(right.id[j]), pa.array(length), limit(line_m), pa.array(area), limit(area_m)]


# -- over Spark ------------------------------------------------------------------------------------------------------

def shape(rings: Column | None = None, lines: Column | None = None) -> list[Column]:
    """A shape's columns: its points in a row, points of each path, and how many of the paths are rings of an area."""
    none = F.expr("cast(array() as array<array<array<double>>>)")
    rings, lines = (none if c is None else F.coalesce(c, none) for c in (rings, lines))
    paths = F.concat(rings, lines)
    return [F.flatten(F.transform(F.flatten(paths), lambda p: F.slice(p, 1, 2))).alias("xy"), F.transform(paths, lambda p: F.size(p)).alias("sizes"), F.size(rings).alias("areas")]


def kinds(shapes: DataFrame, made_of: list[str] | None = None, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """Equal shapes once, so that copies don't meet as pairs: (id, n, box, xy, sizes, areas), the least id of each and how many
    there are; and (id, like), for each shape the least id of its equals.  Keys are digests, as shapes can be large.

    Where a few columns say what a shape is, as a corner and a side do of a square, made_of names them: they are the key,
    no shape need be there yet, and the first table is (id, n, *made_of), the second all columns of shapes and like.
    At most `few` kinds are broadcast to find each shape's; more are shuffled with the shapes.
    """
    form = made_of or ["box", "xy", "sizes", "areas"]
    keyed, key = (shapes, made_of) if made_of else (shapes.select("id", F.sha2(F.to_json(F.struct(*form)), 256).alias("key"), *form), ["key"])
    once = checkpointed(keyed.groupBy(*dict.fromkeys([*key, *form])).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    like = once.select(*[F.col(c).alias(f"__{c}") for c in key], F.col("id").alias("like"))
    if once.count() <= few:
        like = F.broadcast(like)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key]
    own = (keyed if made_of else keyed.select("id", "key")).join(like, same).drop(*[f"__{c}" for c in key])
    return once.select("id", "n", *form), own if made_of else own.select("id", "like")


def tiles(lefts: DataFrame, held: int = HELD) -> DataFrame:
    """(tx, ty, blocks): for each tile that parcels touch, a digit for each of its blocks, column by column: 0 where there is
    no parcel, else how often the tile's sides are halved to the cells there, so that they hold about `held` parcels."""
    fine = (1 << FINEST) / TILE
    at = lambda c: F.floor(F.col(f"box.{c}") * ((1 << BLOCKS) / TILE))
    touched = lambda c: F.explode(F.sequence(at(f"min{c}"), at(f"max{c}")))

    def middle(c: str) -> Column:
        first = F.shiftleft(f"b{c}", FINEST - BLOCKS)
        return F.greatest(first, F.least(first + (1 << FINEST - BLOCKS) - 1, F.floor((F.col(f"box.min{c}") + F.col(f"box.max{c}")) / 2 * fine)))

    rows = lefts.filter("box.minx is not null").select("box", touched("x").alias("bx")).select("box", "bx", touched("y").alias("by"))
    counts = rows.groupBy("bx", "by", middle("x").alias("fx"), middle("y").alias("fy")).agg(F.count(F.lit(1)).alias("n"))
    every = counts.withColumn("k", F.explode(F.sequence(F.lit(BLOCKS), F.lit(FINEST))))
    cells = every.groupBy("bx", "by", "k", F.expr(f"shiftright(fx, {FINEST} - k)").alias("cx"), F.expr(f"shiftright(fy, {FINEST} - k)").alias("cy")).agg(F.sum("n").alias("n"))
    most = cells.groupBy("bx", "by", "k").agg(F.max("n").alias("n"))
    level = most.groupBy("bx", "by").agg(F.coalesce(F.min(F.when(F.col("n") <= held, F.col("k"))), F.lit(FINEST)).alias("k"))
    place = F.expr(f"cast(pmod(bx, {1 << BLOCKS}) * {1 << BLOCKS} + pmod(by, {1 << BLOCKS}) as int)")
    by_tile = level.groupBy(F.shiftright("bx", BLOCKS).alias("tx"), F.shiftright("by", BLOCKS).alias("ty")).agg(F.map_from_entries(F.collect_list(F.struct(place, F.col("k").cast("string")))).alias("m"))
    return by_tile.select("tx", "ty", F.array_join(F.transform(F.sequence(F.lit(0), F.lit((1 << 2 * BLOCKS) - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit("0"))), "").alias("blocks"))


def cut(shapes: DataFrame, known: DataFrame, reach: float) -> DataFrame:
    """shapes (id, box, xy, sizes, areas) to their pieces in cells of known tiles, cut to the cells and a SKIRT around them.

    A shape has a piece in each cell that its box, grown by so many metres, touches and where a part of it is left.
    Rings are closed, those under four points and lines under two dropped.
    """
    box = [F.col(f"box.{c}") for c in ("minx", "miny", "maxx", "maxy")]
    dy, far = reach / METRES, F.greatest(F.abs(box[1]), F.abs(box[3]))
    dx = reach / (METRES * F.greatest(F.lit(0.01), F.cos(F.radians(F.least(F.lit(89.0), far + dy)))))
    wide = (box[0] - dx, box[1] - dy, box[2] + dx, box[3] + dy)
    tile = lambda v: F.shiftright(F.floor(v * ((1 << BLOCKS) / TILE)), BLOCKS)
    side = lambda low, high: F.sequence(tile(low), tile(high))
    rows = shapes.filter("box.minx is not null").select("id", *[c.alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"), strict=True)], "xy", "sizes", "areas", F.explode(side(wide[0], wide[2])).alias("tx"), *[w.alias(f"w{i}") for i, w in enumerate(wide)])
    rows = rows.withColumn("ty", F.explode(side(F.col("w1"), F.col("w3")))).join(F.broadcast(known), ["tx", "ty"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                points, at, paths = np.array(r["xy"], np.float64).reshape(-1, 2), 0, []
                for n, size in enumerate(r["sizes"]):
                    p, at, ring = points[at:at + size], at + size, n < r["areas"]
                    if ring and size and (p[0] != p[-1]).any():
                        p = np.concatenate([p, p[:1]])
                    if len(p) >= (4 if ring else 2):
                        paths.append((ring, p))
                if not paths:
                    continue
                first = points[0].tolist()
                for k, cx, cy, got in cells(r, paths):
                    got.sort(key=lambda x: not x[0])
                    out.append((r["id"], r["x0"], r["y0"], r["x1"], r["y1"], *first, np.concatenate([p for _, p in got]).reshape(-1).tolist(), [len(p) for _, p in got], sum(x for x, _ in got), k, cx, cy))
            names = [c.split()[0] for c in _PIECE.split(", ")]
            types = [pa.int64(), *[pa.float64()] * 6, pa.list_(pa.float64()), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(list(v), t) for v, t in zip(zip(*out, strict=True) if out else [[]] * len(names), types, strict=True)], names)

    def cells(r: dict, paths: list) -> Iterator[tuple]:
        blocks = np.frombuffer(r["blocks"].encode(), np.uint8).reshape(1 << BLOCKS, -1) - 48
        ti, tj = r["tx"] << BLOCKS, r["ty"] << BLOCKS

        def span(k: int, low: float, high: float, first: int, last: int) -> tuple[int, int]:
            scale = (1 << k) / TILE
            return max(math.floor(low * scale), first), min(math.floor(high * scale), last)

        n = (1 << BLOCKS) - 1
        todo = [(BLOCKS, *span(BLOCKS, r["w0"], r["w2"], ti, ti + n), *span(BLOCKS, r["w1"], r["w3"], tj, tj + n), paths)]
        while todo:  # halves the range of blocks, then of cells, until one is left, with what of the shape is in it
            k, i0, i1, j0, j1, got = todo.pop()
            if i0 > i1 or j0 > j1 or k == BLOCKS and not blocks[i0 - ti:i1 - ti + 1, j0 - tj:j1 - tj + 1].any():
                continue
            step = TILE / (1 << k)
            limit = skirt(i0 * step, j0 * step, (i1 + 1) * step, (j1 + 1) * step)
            got = [(ring, x) for ring, p in got for x in (clipped_rings([p], limit) if ring else clipped_line(p, limit))]
            if not got:
                continue
            if i0 == i1 and j0 == j1:
                own = int(blocks[i0 - ti, j0 - tj]) if k == BLOCKS else k
                if own == k:
                    yield k, i0, j0, got
                else:
                    up = own - BLOCKS
                    todo.append((own, *span(own, r["w0"], r["w2"], i0 << up, ((i0 + 1) << up) - 1), *span(own, r["w1"], r["w3"], j0 << up, ((j0 + 1) << up) - 1), got))
            elif i1 - i0 >= j1 - j0:
                m = (i0 + i1) // 2
                todo += [(k, i0, m, j0, j1, got), (k, m + 1, i1, j0, j1, got)]
            else:
                m = (j0 + j1) // 2
                todo += [(k, i0, i1, j0, m, got), (k, i0, i1, m + 1, j1, got)]

    return rows.mapInArrow(run, _PIECE)


def skirt(x0: float, y0: float, x1: float, y1: float) -> tuple[float, float, float, float]:
    """A box with the SKIRT around it."""
    dy, far = SKIRT / METRES, max(abs(y0), abs(y1))
    dx = SKIRT / (METRES * max(0.01, math.cos(math.radians(min(89.0, far + dy)))))
    return x0 - dx, y0 - dy, x1 + dx, y1 + dy


def dealt(lefts: DataFrame, rights: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Pieces with columns l and r: pieces of a cell that holds very many on a side are dealt over tasks there, and those
    of the other side go to each of these.  Fewer than HOT_SHARE cells a side are hot, whatever the data."""
    count = lambda d, n: d.groupBy(*CELL).agg(F.count(F.lit(1)).alias(n))
    both = count(lefts, "nl").join(count(rights, "nr"), CELL)
    nl, nr, most_l, most_r = both.agg(F.sum("nl"), F.sum("nr"), F.max("nl"), F.max("nr")).first()
    if max(most_l or 0, most_r or 0) <= chunk:
        return tuple(d.withColumns({"l": F.lit(0), "r": F.lit(0)}) for d in (lefts, rights))
    many = lambda c, total: (F.col(c) > chunk) & (F.col(c) * HOT_SHARE > (total or 0))
    hot = F.broadcast(both.filter(many("nl", nl) | many("nr", nr)).select(*CELL, *[F.expr(f"cast(ceil({c} / {chunk}) as int)").alias(o) for c, o in (("nl", "ml"), ("nr", "mr"))]))

    def deal(d: DataFrame, own: str, other: str, n_own: str, n_other: str) -> DataFrame:
        d = d.join(hot, CELL, "left").withColumn(own, F.coalesce(F.pmod(F.xxhash64("id"), F.col(n_own)), F.lit(0)).cast("int"))
        return d.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n_other), F.lit(1)) - 1))).drop("ml", "mr")

    return deal(lefts, "l", "r", "ml", "mr"), deal(rights, "r", "l", "mr", "ml")


def touched(rows: DataFrame, box: str, known: DataFrame) -> DataFrame:
    """rows, once for each cell of known tiles that their box (a struct) touches."""
    edge = lambda c, k: F.expr(f"floor({box}.{c} * (shiftleft(1L, {k}) / {TILE}D))")
    out = rows
    for axis in "xy":
        out = out.withColumn(f"b{axis}", F.explode(F.sequence(edge(f"min{axis}", BLOCKS), edge(f"max{axis}", BLOCKS)))).withColumn(f"t{axis}", F.shiftright(f"b{axis}", BLOCKS))
    side = 1 << BLOCKS
    out = out.join(F.broadcast(known), ["tx", "ty"]).withColumn("k", F.expr(f"cast(substring(blocks, cast(pmod(bx, {side}) * {side} + pmod(by, {side}) as int) + 1, 1) as int)")).filter("k > 0")
    for axis in "xy":
        first, last = F.expr(f"shiftleft(b{axis}, k - {BLOCKS})"), F.expr(f"shiftleft(b{axis} + 1, k - {BLOCKS}) - 1")
        out = out.withColumn(f"c{axis}", F.explode(F.sequence(F.greatest(edge(f"min{axis}", "k"), first), F.least(edge(f"max{axis}", "k"), last))))
    return out.select(*rows.columns, *CELL)


def listed(rows: DataFrame, once: DataFrame, chunk: int) -> DataFrame:
    """(like, ids): the ids of rows (id, box) with equal boxes, by the id of their kind in once (id, box, n); those of a kind with
    very many in several lists.  Fewer than HOT_SHARE kinds are dealt so, whatever the data."""
    total = once.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(once.filter((F.col("n") > chunk) & (F.col("n") * HOT_SHARE > total)).select("box", F.expr(f"cast(ceil(n / {chunk}) as int)").alias("m")))
    part = F.coalesce(F.pmod(F.xxhash64("id"), F.col("m")), F.lit(0))
    lists = rows.join(hot, "box", "left").groupBy("box", part.alias("part")).agg(F.collect_list("id").alias("ids"))
    return lists.join(once.select("box", F.col("id").alias("like")), "box").select("like", "ids")


def near_boxes(left: DataFrame, right: DataFrame, metres: float = RADIUS_M, held: int = HELD, chunk: int = CHUNK) -> DataFrame:
    """Pairs (left_id, right_id) of rows (id, box), ids told apart, whose boxes come within so many metres; null boxes come near nothing.

    Equal boxes meet others once, and their ids are put in as lists; what lists make of it is as long as the answer.  Boxes
    meet in cells that are as small as either layer is dense; a pair is told in one of the cells that both touch, the one
    with the corner of what they share, so pairs need not be shuffled to be told once.
    """
    left, right = (d.filter("box.minx is not null").select("id", "box") for d in (left, right))
    ones, others = (checkpointed(d.groupBy("box").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))) for d in (left, right))
    known = checkpointed(tiles(ones.select("box").unionByName(others.select("box")), held))
    grown = expanded(tuple(F.col(f"box.{c}") for c in ("minx", "miny", "maxx", "maxy")), metres)
    wide = F.struct(*[g.alias(c) for g, c in zip(grown, ("minx", "miny", "maxx", "maxy"), strict=True)])
    a = touched(ones.select("id", wide.alias("wide")), "wide", known)
    b = touched(others.select("id", F.col("box").alias("near")), "near", known)
    a, b = dealt(checkpointed(a), checkpointed(b), chunk)
    keys = [*CELL, "l", "r"]
    both = a.select(F.col("id").alias("left_id"), "wide", *keys).join(b.select(F.col("id").alias("right_id"), "near", *keys), keys)
    here = [F.expr(f"floor(greatest(wide.min{x}, near.min{x}) * (shiftleft(1L, k) / {TILE}D)) = c{x}") for x in "xy"]
    met = both.filter(boxes_meet("wide", "near") & here[0] & here[1]).select("left_id", "right_id")
    lefts, rights = (listed(d, o, chunk).select(F.col("like").alias(c), F.col("ids").alias(f"{c}s")) for d, o, c in ((left, ones, "left_id"), (right, others, "right_id")))
    # lists are short next to the pairs that they make, so they are dealt over all tasks, however few they are
    lists = met.join(rights, "right_id").join(lefts, "left_id").select("left_ids", "right_ids").repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return lists.select(F.explode("left_ids").alias("left_id"), "right_ids").select("left_id", F.explode("right_ids").alias("right_id"))


def normalised(shapes: DataFrame, known: DataFrame) -> DataFrame:
    """The pieces of features, kept, so that several measures can use them."""
    return checkpointed(cut(shapes, known, SKIRT))


def measured(parcels: DataFrame, pieces: DataFrame, known: DataFrame, lines: bool = True, areas: bool = True, chunk: int = CHUNK) -> DataFrame:
    """parcels (id, box, xy, sizes, areas; areas alone) against normalised() features of the same tiles.

    left_id, right_id, inside_m and line_m (metres of the feature's lines inside of the parcel, their distance), overlap_m2
    and area_m (shared area, distance of areas) for each pair whose boxes come within RADIUS_M and where both have a
    part in a cell; distances beyond RADIUS_M, or of parts that are not there, are null.
    """
    lefts = checkpointed(cut(parcels, known, 0.0))
    left, right = dealt(lefts, pieces, chunk)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        found = []
        if a.num_rows and b.num_rows:
            step = TILE / (1 << a["k"][0].as_py())
            cx, cy = a["cx"][0].as_py(), a["cy"][0].as_py()
            cell = (cx * step, cy * step, (cx + 1) * step, (cy + 1) * step)
            limit = skirt(*cell)
            found = list(measured_cell(Pieces(a, limit), Pieces(b, limit), cell, lines, areas))
        schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.float64()) for c in _MEASURE.split(", ")])
        return pa.Table.from_batches([pa.record_batch(c, schema=schema) for c in found], schema)

    keys = [*CELL, "l", "r"]
    each = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, _MEASURE)
    return each.groupBy("left_id", "right_id").agg(F.sum("inside_m").alias("inside_m"), F.min("line_m").alias("line_m"), F.sum("overlap_m2").alias("overlap_m2"), F.min("area_m").alias("area_m"))
