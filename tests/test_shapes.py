"""Cutting of shapes, and measures that add up over cells: against measures of whole shapes, pair by pair."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landrank.operators import geometry, shapes
from tests import plain_geometry as plain


def star(rng, cx, cy, r, n=9):
    at = np.linspace(0, -2 * math.pi, n, endpoint=False)
    ring = [[float(cx + d * math.cos(t)), float(cy + d * math.sin(t))] for d, t in zip(r * (0.4 + rng.random(n)), at, strict=True)]
    return ring + ring[:1]


def square(x, y, side):
    return [[x, y], [x, y + side], [x + side, y + side], [x + side, y], [x, y]]


def box_ring(b):
    return [[b[0], b[1]], [b[0], b[3]], [b[2], b[3]], [b[2], b[1]], [b[0], b[1]]]


def area(rings):
    k = geometry.EARTH_M * math.pi / 180
    return abs(sum(float(np.sum(r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1])) for r in rings)) / 2 * k * k


def test_cut_polygons():
    """Rings with holes and parts, concave ones too: what is left of them in a box has the area that they share with it."""
    rng = np.random.default_rng(7)
    for n in range(60):
        rings = [star(rng, 0, 0, 0.01), square(-0.001, -0.001, 0.002)[::-1], star(rng, 0.03, 0.0, 0.006, 7)]
        x0, y0 = rng.uniform(-0.015, 0.03), rng.uniform(-0.012, 0.008)
        box = (x0, y0, x0 + rng.uniform(0.001, 0.03), y0 + rng.uniform(0.001, 0.02))
        got = shapes.clipped_rings([np.array(r) for r in rings], box)
        assert area(got) == pytest.approx(plain.overlap_area(rings, [box_ring(box)]), rel=1e-4, abs=0.01)
        assert all((r[0] == r[-1]).all() and (r >= [box[0], box[1]]).all() and (r <= [box[2], box[3]]).all() for r in got)
    ring = np.array(square(0.0, 0.0, 1.0))
    assert shapes.clipped_rings([ring], (2, 2, 3, 3)) == [] and shapes.clipped_rings([ring], (1, 0, 2, 1)) == []
    assert (shapes.clipped(ring, (-1, -1, 2, 2)) == ring).all() and len(shapes.clipped(ring[:0], (0, 0, 1, 1))) == 0
    broken = np.array([[0, 0], [math.nan, 1], [1, 1], [0, 0]])
    assert shapes.clipped_rings([broken], (5, 5, 6, 6))[0] is broken


def test_cut_lines():
    rng = np.random.default_rng(8)
    for _ in range(40):
        line = rng.uniform(-0.02, 0.02, (12, 2))
        box = (-0.01, -0.008, 0.006, 0.012)
        runs = shapes.clipped_line(line, box)
        k = geometry.EARTH_M * math.pi / 180
        want = plain.measures([box_ring(box)], [line.tolist()])[0]
        assert sum(float(np.hypot(*np.diff(r, axis=0).T).sum()) for r in runs) * k == pytest.approx(want, rel=1e-4, abs=0.01)
    assert shapes.clipped_line(np.array([[0.0, 0.0], [0.0, 0.0]]), (-1, -1, 1, 1))[0].tolist() == [[0, 0], [0, 0]] and shapes.clipped_line(np.array([[2.0, 0.0], [2.0, 1.0]]), (0, 0, 1, 1)) == []


SHAPE = "id long, box struct<minx:double,miny:double,maxx:double,maxy:double>, rings array<array<array<double>>>, lines array<array<array<double>>>"


def frame(spark, rows):
    def box(rings, lines):
        p = np.array([x for r in rings + lines for x in r])
        return (*map(float, p.min(0)), *map(float, p.max(0)))
    made = spark.createDataFrame([(i, box(rings, lines), rings, lines) for i, rings, lines in rows], SHAPE)
    return made.select("id", "box", *shapes.shape(F.col("rings"), F.col("lines")))


def near(one, two):
    (a, b), m = (np.array([x for r in s[1] + s[2] for x in r]) for s in (one, two)), 500
    (x0, y0), (x1, y1) = a.min(0), a.max(0)
    dx, dy = m / (geometry.DEGREE_M * max(0.1, math.cos(math.radians((y0 + y1) / 2)))), m / geometry.DEGREE_M
    return x0 - dx <= b[:, 0].max() and b[:, 0].min() <= x1 + dx and y0 - dy <= b[:, 1].max() and b[:, 1].min() <= y1 + dy


@pytest.mark.parametrize(("held", "chunk"), [(256, 4096), (3, 4)])
def test_cells_add_up(spark, held, chunk, monkeypatch):
    """Parcels and features over several tiles, cells and chunks of a cell, rivers and zones longer than a tile among them."""
    monkeypatch.setattr(shapes, "HOT_SHARE", 10 ** 6)
    rng = np.random.default_rng(9)
    at = lambda: (float(rng.normal(-81.6, 0.03)), float(rng.normal(36.0, 0.03)))
    lefts = [(i, [star(rng, *at(), 0.006)] + ([square(-81.6 + i / 1000, 36.25, 0.002)] if i % 4 == 0 else []), []) for i in range(40)]
    lefts += [(50, [square(-81.604, 35.996, 0.008), square(-81.602, 35.998, 0.003)[::-1]], []), (51, [square(-82.0, 35.7, 0.7)], [])]
    rights = []
    for j in range(40):
        x, y = at()
        line = np.cumsum(np.concatenate([[[x, y]], rng.normal(0, 0.004, (9, 2))]), axis=0).tolist()
        rights.append((j, [star(rng, *at(), 0.008, 12)] if j % 3 else [], [line] if j % 2 or not j % 3 else []))
    rights += [(60, [], [[[-83.5, 35.99], [-81.61, 36.0], [-80.0, 36.01]]]), (61, [square(-82.5, 35.5, 1.5), square(-81.65, 35.97, 0.1)[::-1]], []), (62, [square(-81.601, 35.999, 0.0015)], [])]
    p, f = frame(spark, lefts), frame(spark, rights)
    known = shapes.tiles(p, held)
    levels = set("".join(r["blocks"] for r in known.collect()))
    assert all(len(r["blocks"]) == 256 for r in known.collect()) and levels == ({"0", "4"} if held > 3 else set("045678")), levels
    got = {(r["left_id"], r["right_id"]): r for r in shapes.measured(p, shapes.normalised(f, known), known, chunk=chunk).collect()}
    seen = 0
    for one in lefts:
        for two in rights:
            r = got.get((one[0], two[0]))
            length, line_m = plain.measures(one[1], two[2])
            shared, area_m = plain.overlap_area(one[1], two[1]), plain.polygon_distance(one[1], two[1])
            if r is None:
                assert min(line_m, area_m) > 490 or not near(one, two), (one[0], two[0])
                continue
            seen += 1
            assert r["inside_m"] == pytest.approx(length, rel=1e-6, abs=1e-3) and r["overlap_m2"] == pytest.approx(shared, rel=1e-6, abs=0.5), (one[0], two[0])
            for a, b in ((r["line_m"], line_m), (r["area_m"], area_m)):
                assert b > 499.99 if a is None else a == pytest.approx(b, rel=1e-6, abs=1e-3), (one[0], two[0], a, b)
    assert seen > 150


def test_dense_cells_travel_once(spark):
    """Very many parcels and features in one place: pieces grow as shapes do, not as pairs."""
    rng = np.random.default_rng(10)
    lefts = [(i, [square(float(x), float(y), 0.0005)], []) for i, (x, y) in enumerate(rng.normal([-81.6, 36.0], 0.003, (2000, 2)))]
    rights = [(i, [square(float(x), float(y), 0.0005)], []) for i, (x, y) in enumerate(rng.normal([-81.6, 36.0], 0.003, (2000, 2)))]
    p, f = frame(spark, lefts), frame(spark, rights)
    known = shapes.tiles(p)
    assert shapes.cut(p, known, 0.0).count() < 3 * len(lefts) and shapes.normalised(f, known).count() < 40 * len(rights)


@pytest.mark.parametrize(("held", "chunk"), [(256, 4096), (4, 8)])
def test_near_boxes_are_all_pairs(spark, held, chunk, monkeypatch):
    """Dense, far and large boxes, boxes on tile borders and at one place: each near pair once, as comparing all gives it."""
    monkeypatch.setattr(shapes, "HOT_SHARE", 10 ** 6)
    rng = np.random.default_rng(12)

    def boxes(n):
        at = np.concatenate([rng.normal([-81.6, 36.0], 0.01, (n, 2)), rng.uniform([-83, 35], [-80, 37], (n // 2, 2)), np.full((n // 4, 2), 0.8), [[-83.0, 35.0], [-0.4, -0.4]]])
        size = np.concatenate([rng.uniform(0, 0.004, (len(at) - 2, 2)), [[3.0, 2.0], [0.8, 0.8]]])
        return [(i, tuple(map(float, (*a, *(a + s))))) for i, (a, s) in enumerate(zip(at, size, strict=True))]

    schema = "id long, box struct<minx:double,miny:double,maxx:double,maxy:double>"
    left, right = boxes(80), boxes(60)
    got = [tuple(r) for r in shapes.near_boxes(spark.createDataFrame([*left, (999, None)], schema), spark.createDataFrame([*right, (999, None)], schema), held=held, chunk=chunk).collect()]
    assert len(got) == len(set(got)) and set(got) == {(i, j) for i, a in left for j, b in right if near((i, [[a[:2], a[2:]]], []), (j, [[b[:2], b[2:]]], []))}


def test_shapes_on_edges(spark):
    """Null and empty shapes, open rings, rings and lines that are too short, no rows."""
    s = spark.createDataFrame([(1, (0.0, 0.0, 0.01, 0.01), [square(0.0, 0.0, 0.01)[:-1]], None), (2, None, None, None), (3, (0.0, 0.0, 0.01, 0.01), [[[0.0, 0.0], [0.01, 0.01]]], [[[0.0, 0.0]]]), (4, (0.0, 0.0, 0.01, 0.01), [], [])], SHAPE)
    s = s.select("id", "box", *shapes.shape(F.col("rings"), F.col("lines")))
    known = shapes.tiles(s)
    assert {r["id"] for r in shapes.cut(s, known, 0.0).select("id").distinct().collect()} == {1}
    got = shapes.measured(s, shapes.normalised(s, known), known).collect()
    assert {(r["left_id"], r["right_id"]) for r in got} == {(1, 1)} and got[0]["area_m"] == 0 and got[0]["overlap_m2"] == pytest.approx(plain.overlap_area([square(0.0, 0.0, 0.01)], [square(0.0, 0.0, 0.01)]))
    none = s.limit(0)
    assert shapes.measured(none, shapes.normalised(s, known), known).count() == 0 and shapes.measured(s, shapes.normalised(none, known), known).count() == 0
