"""Cohorts that hold most rows, exact geometry, writers that race, and rows of the corpus: against brute force."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landrank.operators import cohorts, corpus, geometry, nearest, shapes
from landrank.plans import places
from landrank.sources import writers
from tests import plain_geometry
from tests.oracle import SF, answer, assert_same


def test_a_hot_cohort_of_distinct_values(spark):
    """A third of all rows in one cohort, all values different: ranks are exact, and no run holds much of the cohort."""
    n = 3000
    df = spark.range(n).select(F.when(F.col("id") < n // 3, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10 ** 6)) / 7.0).alias("v"))
    counts = df.groupBy(F.col("k").alias("__k"), F.col("v").alias("__v")).agg(F.count(F.lit(1)).alias("__equal"))
    held = cohorts.runs(counts, 16, 500).filter("__k = 'hot'").groupBy("__run").agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("a"), F.max("__v").alias("b")).orderBy("a").collect()
    assert len(held) > 10 and max(r["n"] for r in held) < n // 6 and all(x["b"] < y["a"] and x["__run"] < y["__run"] for x, y in zip(held, held[1:]))
    one, many = (sorted(map(tuple, cohorts.midrank(df, "k", "v", n_runs=r, many=m).collect())) for r, m in ((64, 10 ** 9), (16, 500)))
    assert len(one) == n and all(a[:2] == b[:2] and a[3] == b[3] and a[2] == pytest.approx(b[2]) for a, b in zip(one, many, strict=True))


def square(x, y, side):
    return [[x, y], [x, y + side], [x + side, y + side], [x + side, y], [x, y]]


def sampled_area(one, other, n=900):
    """Shared square metres by a fine grid of points."""
    a, b = plain_geometry.polygons(one), plain_geometry.polygons(other)
    origin = tuple(a[0][0][0])
    a, b = ([[plain_geometry._local(r, origin) for r in rs] for rs in s] for s in (a, b))
    corners = np.concatenate([r for rs in a for r in rs])
    low, high = corners.min(0), corners.max(0)
    x = [low[k] + (np.arange(n) + 0.5) * (high[k] - low[k]) / n for k in (0, 1)]
    points = np.stack(np.meshgrid(*x), -1).reshape(-1, 2)
    return float((plain_geometry.contains(a, points) & plain_geometry.contains(b, points)).mean() * np.prod(high - low))


def test_overlap_of_any_polygons():
    """Concave rings, holes and parts: against a count of points."""
    rng = np.random.default_rng(1)

    def star(cx, cy, r, n):
        at = np.linspace(0, -2 * math.pi, n, endpoint=False)
        reach = r * (0.5 + rng.random(n))
        return [[cx + d * math.cos(t), cy + d * math.sin(t)] for d, t in zip(reach, at, strict=True)]

    for _ in range(6):
        one = [star(-81.8, 36.1, 0.01, 9), square(-81.802, 36.098, 0.003)[::-1]]
        other = [star(-81.795, 36.103, 0.008, 11), star(-81.81, 36.09, 0.005, 7)]
        got = plain_geometry.overlap_area(one, other)
        assert got == pytest.approx(sampled_area(one, other), rel=0.03, abs=2000) and got == pytest.approx(plain_geometry.overlap_area(one[:1] + one[1:], other))
    hole = [square(-81.8, 36.1, 0.01), square(-81.797, 36.103, 0.004)[::-1]]
    assert plain_geometry.overlap_area(hole, [square(-81.796, 36.104, 0.001)]) == pytest.approx(0, abs=1e-3)
    assert plain_geometry.overlap_area(hole, [square(-81.7, 36.1, 0.01)]) == 0 and plain_geometry.overlap_area([], hole) == 0


def test_distance_of_polygons():
    a, k = [square(-81.8, 36.1, 0.01)], math.pi / 180 * geometry.EARTH_M
    assert plain_geometry.polygon_distance(a, [square(-81.795, 36.105, 0.001)]) == 0 and plain_geometry.polygon_distance([square(-81.795, 36.105, 0.001)], a) == 0
    assert plain_geometry.polygon_distance(a, [square(-81.795, 36.1099, 0.01)]) == 0
    assert plain_geometry.polygon_distance(a, [square(-81.8, 36.112, 0.01)]) == pytest.approx(0.002 * k)
    assert plain_geometry.polygon_distance(a, [square(-81.788, 36.1, 0.01)]) == pytest.approx(0.002 * k * math.cos(math.radians(36.1)))
    assert plain_geometry.polygon_distance(a, []) == math.inf


def test_nearest_is_nearest(spark):
    """Every point finds its nearest feature, near or far, in dense places and at one place; ties go to the least id."""
    rng = np.random.default_rng(2)
    f = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.concatenate([rng.normal([-80, 36], 0.01, (150, 2)), rng.uniform([-120, -50], [10, 60], (12, 2)), [[-80.5, 36.5]] * 3]))]
    p = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.concatenate([rng.normal([-80, 36], 0.05, (80, 2)), rng.uniform([-170, -80], [170, 80], (40, 2)), [[-80.5, 36.5]]]))]
    points = spark.createDataFrame([*p, (999, None, 1.0)], "id long, lng double, lat double")
    got = {r["point_id"]: (r["feature_id"], r["metres"]) for r in nearest.nearest_points(points, spark.createDataFrame(f, "id long, lng double, lat double")).collect()}

    def metres(a, b):
        h = math.sin(math.radians(b[2] - a[2]) / 2) ** 2 + math.cos(math.radians(a[2])) * math.cos(math.radians(b[2])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * geometry.EARTH_M * math.asin(math.sqrt(min(1, h)))

    for a in p:
        best = min((metres(a, b), b[0]) for b in f)
        assert got[a[0]][1] == pytest.approx(best[0], abs=1e-3) and (got[a[0]][0] == best[1] or abs(metres(a, f[got[a[0]][0]]) - best[0]) < 1e-6)
    assert got[999] == (None, None) and got[120][0] == 162 and len(got) == 122
    assert nearest.nearest_points(points, points.limit(0)).filter("feature_id is not null").count() == 0


@pytest.mark.parametrize("layers", ["dense", "far", "sparse", "mixed", "one place"])
@pytest.mark.parametrize("broadcast", [nearest.BROADCAST, 16])
def test_few_pairs_meet(spark, layers, broadcast):
    """Dense, distant, sparse and equal points: exact answers from a small multiple of the points, however nodes are joined."""
    rng = np.random.default_rng(5)
    sphere = lambda n: rng.uniform([-170, -80], [170, 80], (n, 2))
    one, two = {"dense": (rng.normal([-80, 36], 1e-4, (3000, 2)), rng.normal([-80, 36], 1e-4, (3000, 2))), "far": (rng.normal([-80, 36], 0.01, (3000, 2)), rng.normal([20, 10], 0.01, (3000, 2))),
                "sparse": (sphere(3000), sphere(3000)), "one place": (np.full((3000, 2), 30.0), np.concatenate([np.full((700, 2), 30.0), sphere(200)])),
                "mixed": (np.concatenate([rng.normal([-80, 36], 0.01, (500, 2)), sphere(500), np.full((500, 2), 30.0)]), np.concatenate([rng.normal([-80, 36], 1e-5, (800, 2)), sphere(700)]))}[layers]
    made = lambda a: spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(a)], "id long, lng double, lat double")
    found = {r["point_id"]: r["metres"] for r in nearest.nearest_points(made(one), made(two), broadcast).collect()}
    p, f = np.radians(one)[:, None], np.radians(two)[None]
    h = np.sin((f[..., 1] - p[..., 1]) / 2) ** 2 + np.cos(p[..., 1]) * np.cos(f[..., 1]) * np.sin((f[..., 0] - p[..., 0]) / 2) ** 2
    best = (2 * geometry.EARTH_M * np.arcsin(np.sqrt(np.minimum(1, h)))).min(1)
    assert len(found) == len(one) and max(abs(found[i] - d) for i, d in enumerate(best)) < 1e-6
    places = made(np.unique(two, axis=0))
    assert nearest.met(made(one), places, broadcast).count() <= 250 * len(one)


def test_rings_as_polygons(spark):
    """Orientation, holes, parts, open and short rings: as plain code puts them together."""
    out, hole, short = square(0.0, 0.0, 1.0), square(0.2, 0.2, 0.1)[::-1], [[0.0, 0.0], [1.0, 1.0]]
    cases = [[out], [out, hole], [hole, out, hole, hole], [out[:-1], hole[:-1]], [short, hole, out], [], [short], [out, out, hole, short, hole]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)] + [(99, None)], "i int, rings array<array<array<double>>>")
    got = {r["i"]: r["p"] for r in df.select("i", geometry.multipolygon(F.col("rings")).alias("p")).collect()}
    assert all(got[i] == plain_geometry.polygons(c) for i, c in enumerate(cases)) and got[99] is None


def test_features_once(spark):
    ring = [square(0.0, 0.0, 1.0)]
    rows = [(1, ring, 3), (1, [square(0.0, 0.0, 2.0)], 2), (None, ring, 5), (None, ring, 4), (None, [square(1.0, 0.0, 1.0)], 9)]
    got = geometry.deduplicated(spark.createDataFrame(rows, "feature_id long, rings array<array<array<double>>>, ordinal int")).collect()
    assert sorted(r["ordinal"] for r in got) == [2, 4, 9]


def test_runs_are_written_in_one_step(spark, tmp_path):
    """A run is there as a whole or not at all; of two writers one is refused; there is a pointer at any time."""
    path = f"file://{tmp_path}/log"
    ev = spark.createDataFrame([("1", "new")], "record_id string, kind string")
    bad = ev.withColumn("kind", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        writers.append_once(bad, path, "2024-01-02T10:00")
    writers.append_once(ev, path, "2024-01-02T10:00")
    writers.append_once(ev, path, "2024-02-01T10:00")
    with pytest.raises(writers.AlreadyWritten):
        writers.append_once(ev, path, "2024-01-02T10:00")
    assert spark.read.json(path).count() == 2
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    assert not writers.renamed(spark, f"file://{tmp_path}/a", f"file://{tmp_path}/log") and (tmp_path / "a").exists()
    runs = spark.createDataFrame([("x", 3, 1, 1, 1), ("y", 4, 0, 0, 4)], "county string, rows long, inserted long, changed long, unchanged long")
    assert writers.manifest(spark, f"file://{tmp_path}/log", {"run_id": "r1", "status": "complete"}, runs)["rows"] == 7
    assert json.loads((tmp_path / "log" / "r1.json").read_text())["totals"] == {"rows": 7, "inserted": 1, "changed": 1, "unchanged": 5, "counties": 2}


def test_every_kth_and_counties(spark):
    df = spark.range(1000).withColumn("o", 999 - F.col("id"))
    assert sorted(r["o"] for r in corpus.every_kth(df, [F.col("o")], 50).collect()) == list(range(0, 1000, 20))
    seeds = spark.createDataFrame([("37001", "s"), ("37003", None)], "fips string, parcel_source string")
    assert corpus.requested(seeds, ["37003"]).count() == 1
    with pytest.raises(corpus.MissingCounties, match="37005"):
        corpus.requested(seeds, ["37001", "37005"])


@pytest.mark.parametrize("name", ["geo_lines", "geo_water", "geo_flood", "geo_roads"])
def test_equal_shapes_are_measured_once(spark, name, monkeypatch):
    """Parcels and features repeated with other keys: no more shapes and pairs are measured, and the answer is the SQL's."""
    made, met = shapes.measured, []
    monkeypatch.setattr(shapes, "measured", lambda parcels, pieces, *a: (met.append((parcels.count(), pieces.select("id").distinct().count())), made(parcels, pieces, *a))[1])
    assert_same(places.QUERIES[name](spark, SF).toPandas(), answer(places.SQL[name]))
    stored = spark.read.parquet(f"{SF}/customer.parquet")
    assert stored.count() > 1000 and met and met[0][0] <= 840 and met[0][1] <= 840


def test_near_copies_of_boxes(spark, monkeypatch):
    """Many parcels and features of few boxes: kinds meet, not copies, and each pair of copies is told once, from several lists as well."""
    monkeypatch.setattr(shapes, "HOT_SHARE", 10 ** 6)
    kinds = [(x / 100, 36.0, x / 100 + 0.004, 36.004) for x in range(4)]
    layer = lambda n, ids: spark.createDataFrame([(ids + i, kinds[i % 4]) for i in range(n)], "id long, box struct<minx:double,miny:double,maxx:double,maxy:double>")
    met, dealt = [], shapes.dealt
    monkeypatch.setattr(shapes, "dealt", lambda a, b, chunk: (met.append((a.select("id").distinct().count(), b.select("id").distinct().count())), dealt(a, b, chunk))[1])
    got = [tuple(r) for r in shapes.near_boxes(layer(90, 0), layer(70, 500), 100, chunk=8).collect()]
    assert met == [(4, 4)] and len(got) == len(set(got)) and set(got) == {(i, 500 + j) for i in range(90) for j in range(70) if i % 4 == j % 4}


def test_kinds_of_shapes(spark):
    """Equal shapes have the least id; signs of zero and nulls do not lose a shape."""
    rows = [(3, (0.0, 0.0, 1.0, 1.0), [0.0, 0.0, 1.0, 1.0]), (1, (0.0, 0.0, 1.0, 1.0), [0.0, 0.0, 1.0, 1.0]), (2, (-0.0, 0.0, 1.0, 1.0), [-0.0, 0.0, 1.0, 1.0]), (4, None, None), (5, (0.0, 0.0, 1.0, math.nan), [math.nan]), (6, (0.0, 0.0, 1.0, math.nan), [math.nan])]
    df = spark.createDataFrame(rows, "id long, box struct<minx:double,miny:double,maxx:double,maxy:double>, xy array<double>").withColumns({"sizes": F.array(F.lit(2)), "areas": F.lit(0)})
    once, like = shapes.kinds(df)
    assert {r["id"]: r["n"] for r in once.collect()} == {1: 2, 2: 1, 4: 1, 5: 2} and {r["id"]: r["like"] for r in like.collect()} == {3: 1, 1: 1, 2: 2, 4: 4, 5: 5, 6: 5}


def test_listings_are_scored_once(spark):
    """Three counts of scored rows: what is left to do when the answer is asked for holds none of the scoring's joins."""
    from landrank.plans import staging

    assert "Join" not in staging.listing_rows(spark, SF)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["geo_lines", "geo_roads", "geo_flood", "geo_water"])
def test_shapes_are_made_of_kinds_alone(spark, name):
    """Rows are told apart by a corner and a side: no ring is built, written out or hashed for each of them."""
    plan = places.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "to_json" not in plan and "array(array(array(" not in plan


def test_kinds_by_what_they_are_made_of(spark):
    """As digests tell: equal ones meet, nulls are a kind, other columns stay; and alike where kinds are shuffled."""
    rows = [(3, 1.0, 2.0, "a"), (1, 1.0, 2.0, "b"), (2, 2.0, 1.0, "c"), (5, None, 1.0, "d"), (4, None, 1.0, "e")]
    df = spark.createDataFrame(rows, "id long, x double, y double, note string")
    for few in (100, 0):
        once, own = shapes.kinds(df, ["x", "y"], few)
        assert sorted(map(tuple, once.collect())) == [(1, 2, 1.0, 2.0), (2, 1, 2.0, 1.0), (4, 2, None, 1.0)]
        assert {r["id"]: (r["like"], r["note"]) for r in own.collect()} == {3: (1, "a"), 1: (1, "b"), 2: (2, "c"), 5: (4, "d"), 4: (4, "e")}
