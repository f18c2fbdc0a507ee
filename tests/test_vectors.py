"""Operators against worked cases: each rule with a case that keeps it and one that breaks it."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landrank.functions import measured as M
from landrank.functions import text as X
from landrank.operators import cohorts, delta, geometry, keys, quality, score, search, shapes
from landrank.sources import readers, writers
from tests import plain_geometry


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize("raw, value, reason", [
    (None, None, "null"), (" ", None, "empty-string"), ("x", None, "non-numeric"), ("NaN", None, "non-numeric"), ("Infinity", None, "non-numeric"),
    ("0", None, "zero-sentinel"), ("-1", None, "negative"), ("2.5", 2.5, None)])
def test_positive_quantity(spark, raw, value, reason):
    r = one(spark, M.positive_quantity(F.lit(raw).cast("string")).alias("m"))["m"]
    assert (r["value"], r["unknown_reason"]) == (value, reason)


def test_numbers_take_no_detour_by_text(spark):
    """Doubles and whole numbers are measured as they are, with the reasons that their texts give; floats and decimals by their text, as feeds write them."""
    values = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, -1.5, 0.1, 1e300, 5e-324, 123456789.125]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select(M.positive_quantity(F.col("x")).alias("m"), M.positive_quantity(F.col("x").cast("string")).alias("t"))
    assert all(r["m"] == r["t"] for r in got.collect())
    plan = df.select(M.safe_divide(M.positive_quantity(F.col("x")), M.positive_quantity(F.col("x"))).alias("q"))._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in plan and "trim" not in plan
    assert one(spark, M.positive_quantity(F.lit(7)).alias("m"))["m"]["value"] == 7 and one(spark, M.positive_quantity(F.expr("0.1f")).alias("m"))["m"]["value"] == 0.1
    assert one(spark, M.positive_quantity(F.expr("2.50BD")).alias("m"))["m"]["value"] == 2.5 and one(spark, M.positive_quantity(F.lit(True)).alias("m"))["m"]["unknown_reason"] == "non-numeric"


@pytest.mark.parametrize("raw, reason", [
    ("-2208988800000", "date-sentinel"), ("0", "zero-sentinel"), ("1/1/1900 12:00:00 AM", "date-sentinel"), ("soon", "non-numeric"), ("1700000000000", None),
    ("9000000000000", "implausible-date"), ("2020-05-01", None), ("-6847804800000", "date-sentinel"), ("-9000000000000", "implausible-date")])
def test_dates(spark, raw, reason):
    assert one(spark, M.plausible_date(F.lit(raw)).alias("m"))["m"]["unknown_reason"] == reason


def test_division_and_clamp(spark):
    q = lambda a, b: one(spark, M.safe_divide(M.positive_quantity(F.lit(a)), M.positive_quantity(F.lit(b))).alias("m"))["m"]
    assert q("6", "3")["value"] == 2 and q("0", "-1")["unknown_reason"] == "zero-sentinel" and q("1", "-1")["unknown_reason"] == "negative"
    r = one(spark, M.clamp(F.lit(float("nan")), 0, 100).alias("a"), M.clamp(F.lit(None).cast("double"), 0, 1).alias("b"), M.clamp(F.lit(7.0), 0, 5).alias("c"),
            M.js_round(F.lit(-0.5)).alias("d"), M.js_round(F.lit(1.005), 2).alias("e"))
    assert r["a"] != r["a"] and r["b"] is None and r["c"] == 5 and r["d"] == 0 and r["e"] == 1.0


def percentiles(values):
    return [(sum(v < x for v in values) + sum(v == x for v in values) / 2) / len(values) * 100 for x in values]


def test_midrank(spark):
    values = [1, 3, 3, 7, 9, 12, 12, 12, 40]
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 1.0), (None, 5.0)], "k string, v double")
    got = {(r["k"], r["v"]): (r["percentile"], r["cohort_size"]) for r in cohorts.midrank(df, "k", "v").collect()}
    for v, p in zip(values, percentiles(values), strict=True):
        assert got["a", v] == (pytest.approx(p), 9)
    assert got["b", 1.0] == (50, 1) and got[None, 5.0] == (None, None)
    assert round(got["a", 1.0][0], 4) == 5.5556 and round(got["a", 40.0][0], 4) == 94.4444


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=30))
def test_midrank_is_the_counting_form(spark, values):
    df = spark.createDataFrame([("a", float(v)) for v in values], "k string, v double")
    got = {r["v"]: r["percentile"] for r in cohorts.midrank(df, "k", "v").collect()}
    assert all(got[v] == pytest.approx(p) for v, p in zip(values, percentiles(values), strict=True))


def test_floor_and_basis(spark):
    df = spark.createDataFrame([("a", 100.0)] * 60 + [("a", 101.0 + i) for i in range(60)] + [("b", 5.0)] * 3, "k string, v double")
    assert [tuple(r) for r in cohorts.value_floors(df, "k", "v", 50).collect()] == [("a", 100.0, 60)]
    cohorts.one_basis(df.withColumn("basis", F.lit("gis")), "k", "basis")
    with pytest.raises(cohorts.MixedBasis):
        cohorts.one_basis(df.withColumn("basis", F.when(F.col("v") > 120, "gis").otherwise("deeded")), "k", "basis")


def test_roll_up(spark):
    known = lambda n, w, x: score.component(n, w, F.lit(x), F.lit(x), F.lit(float(w)), F.lit(None).cast("string"))
    none = lambda n, w: score.component(n, w, F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit("why"))
    r = one(spark, score.rolled_up(F.array(known("a", 20, 90.0), known("b", 15, 40.0), none("c", 30), none("d", 20), none("e", 15))).alias("r"))["r"]
    assert r["total"] == pytest.approx(2400 / 35) and r["confidence"] == pytest.approx(0.35) and r["score"] == 69 and r["unknown_count"] == 3
    r = one(spark, score.rolled_up(F.array(none("c", 100))).alias("r"))["r"]
    assert (r["total"], r["confidence"], r["score"]) == (0, 0, None)
    assert score.incoherent(spark.range(1).select(F.array(known("a", 20, 90.0), none("b", 1)).alias("components"))).count() == 0
    with pytest.raises(ValueError):
        score.Config(weights={"a": 50.0}).check()
    with pytest.raises(ValueError):
        score.Config().check(("unheard_of",))
    score.Config().check(("tax_sale_listed",))


@pytest.mark.parametrize("frontage, flow, normalized", [(212.0, 0.0, 100), (None, 50.0, 70), (0.0, 399.0, 40), (None, 900.0, 0), (None, None, None)])
def test_water(spark, frontage, flow, normalized):
    d = lambda x: F.lit(x).cast("double")
    assert one(spark, score.water(d(frontage), d(flow), d(None), F.lit(True)).alias("c"))["c"]["normalized"] == normalized


@pytest.mark.parametrize("x, label", [(0.5, "0-1"), (1.0, "0-1"), (1.01, "1-5"), (9000.0, "500+"), (0.0, None), (None, None)])
def test_bands(spark, x, label):
    assert one(spark, X.band(F.lit(x).cast("double"), [1, 5, 10, 25, 50, 100, 500]).alias("b"))["b"] == label


def test_gates(spark):
    g = lambda *a: one(spark, score.veto_reasons(score.gates(*map(F.lit, a))).alias("r"))["r"]
    assert g(True, False, "x", "y", 5.0) == ["government"] and g(True, True, "x", "y", 5.0) == []
    assert g(False, False, "Exclusions (commone areas)", "y", 0.05) == ["use-class", "acreage"]
    assert g(False, False, "x", "ROAD R/W SILVER", 5.0) == ["situs"] and g(False, False, "x", "RW ROAD", 5.0) == []


def test_text(spark):
    r = one(spark, X.sale_date(F.lit("Sale of March 5, 2024 and")).alias("a"), X.sale_date(F.lit("March 2024")).alias("b"), X.money(F.lit("$1,234.50")).alias("c"),
            X.money(F.lit("-")).alias("d"), X.classify(F.lit("Tax  Foreclosure of")).alias("e"), X.is_bare_origin(F.lit("https://a.org/")).alias("f"),
            X.is_bare_origin(F.lit("https://a.org/x")).alias("g"), X.sfha(F.lit("d")).alias("h"), X.sfha(F.lit(" ae ")).alias("i"), X.normal_key(F.lit(" a b ")).alias("j"),
            X.regime(F.lit(46006)).alias("k"), X.is_perennial_body(F.lit(43610)).alias("l"), X.value_basis(F.lit(" Taxable")).alias("m"), X.show_money(F.lit(None).cast("double")).alias("n"))
    assert (r["a"], r["b"], r["c"], r["d"], r["e"]) == ("2024-03-05", None, 1234.5, None, "tax-foreclosure")
    assert r["f"] and not r["g"] and r["h"] is None and r["i"] and r["j"] == "AB" and r["k"] == "perennial" and r["l"] and r["m"] == "net_of_exemptions" and r["n"] == "unknown"


RAW = "objectid long, parno string, stcntyfips string, cntyname string, parval double, gisacres double, parvaltype string, saledate string, sourcedate string, parusedesc string, siteadd string, ownname string, mstate string"


def test_staging(spark):
    row = lambda i, parno, val, use="R": (i, parno, "37001", "", val, 2.0, "Assessed", "1500000000000", "0", use, "a", "ACME LLC", "TN")
    raw = spark.createDataFrame([row(1, " 00 01", 5.0), row(2, "0002", 1.0), row(3, "0002", 2.0), row(4, "0002", 2.0), row(5, "", 1.0)], RAW)
    out, unkeyed = keys.staged(raw, "NC", "Watauga", 1_700_000_000_000)
    got = {r["record_id"]: r for r in out.collect()}
    assert sorted(got) == ["37001:0001:0", "37001:0002:0", "37001:0002:1"] and got["37001:0002:1"]["part_count"] == 2
    assert [r["reason"] for r in unkeyed.collect()] == ["empty-parno"]
    r = got["37001:0001:0"]
    assert r["owner_out_of_state"] and r["owner_is_entity"] and not r["owner_is_government"] and r["tenure_years"] == 6 and r["deed_date_unknown_reason"] == "zero-sentinel" and r["county"] == "Watauga"
    assert not set(keys.PERSONAL) & set(out.columns) and keys.collisions(out).count() == 0
    with pytest.raises(keys.Personal):
        keys.assert_no_personal(raw)


def test_vintage(spark):
    df = spark.createDataFrame([("37001 ", "A"), ("9", "b ")], "fips string, county string")
    v = spark.createDataFrame([("37001", "A", 2020), ("37002", "B", 2021)], "fips string, county string, last_reappraisal_year int")
    assert [r["assessment_year"] for r in keys.vintage_joined(df, v).orderBy("county").collect()] == [2020, 2021]
    with pytest.raises(PySparkException):
        keys.vintage_joined(spark.createDataFrame([("37001", "B")], df.schema), v).collect()


def test_snapshots(spark):
    prior = spark.createDataFrame([(1, "p", "x", "active", "t0", "t0"), (2, "p", "x", "stale", "t0", "t0"), (3, "p", "x", "active", "t0", "t0"), (4, "q", "x", "active", "t0", "t0"), (5, "p", "x", "stale", "t0", "t0")],
                                  "k int, part string, v string, status string, first_seen string, last_seen string")
    staged = spark.createDataFrame([(1, "p", "y"), (2, "p", "x"), (5, "p", "z"), (6, "p", "x")], "k int, part string, v string")
    done = spark.createDataFrame([("p",)], "part string")
    ev = sorted((r["k"], r["kind"], r["before"], r["after"]) for r in delta.change_events(staged, prior, "k", "part", ["v"], done).collect())
    assert ev == [(1, "changed", "x", "y"), (2, "returned", None, None), (3, "stale", None, None), (5, "changed", "x", "z"), (6, "new", None, None)]
    nxt = {r["k"]: (r["status"], r["first_seen"], r["last_seen"]) for r in delta.carried_forward(staged, prior, "k", "part", done, F.lit("t1")).collect()}
    assert nxt == {1: ("active", "t0", "t1"), 2: ("active", "t0", "t1"), 5: ("active", "t0", "t1"), 6: ("active", "t1", "t1"), 3: ("stale", "t0", "t0"), 4: ("active", "t0", "t0")}
    again = delta.change_events(staged, delta.carried_forward(staged, prior, "k", "part", done, F.lit("t1")), "k", "part", ["v"], done)
    assert again.count() == 0
    with pytest.raises(delta.StateLost):
        delta.assert_state(prior.limit(0), done)


def test_facets_keep_unknowns_apart(spark):
    df = spark.createDataFrame([(1, 50, 5.0, 10.0, True), (2, None, None, None, None), (3, 10, 1.0, 99.0, False)], "id int, score int, acreage double, price double, in_flood boolean")
    df = df.withColumns({"state": F.lit("NC"), "fips": F.lit("1"), "use": F.lit("TIMBER"), "has_water": F.col("in_flood"), "search": F.lit("abc")})
    ids = lambda **k: sorted(r["id"] for r in search.facets(df, **k).collect())
    assert ids() == [1, 2, 3] and ids(min_score=20) == [1] and ids(min_acres=2) == [1] and ids(max_price=50) == [1, 2] and ids(no_flood=True) == [2, 3]
    assert ids(water=True) == [1] and ids(lane_is="prospect") == [2] and ids(land=True) == [] and ids(land=True, land_uses=("TIMBER",)) == [1, 2, 3] and ids(query="B") == [1, 2, 3]


def test_denylist(spark):
    rules = spark.createDataFrame([(0, "auction.com", "/x"), (1, "*.list.org", None)], "ordinal int, host string, path string")
    urls = spark.createDataFrame([("https://www.auction.com/X/1",), ("https://auction.com/y",), ("https://list.org/",), ("https://nolist.org/",)], "url string")
    assert [r["rule"] for r in search.denied(urls, rules).orderBy("url").collect()] == [None, 1, None, 0]


def test_allow_list(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert search.allow_listed(df, ["b", "a", "c"]).columns == ["b", "a"]
    with pytest.raises(ValueError):
        search.allow_listed(df, ["a"])


def test_gate_matrix(spark):
    h = lambda e, f, lim, n: one(spark, quality.healthy(F.lit(e).cast("string"), F.lit(f), F.lit(lim), F.lit(n), 2).alias("x"))["x"]
    assert (h("500", "f", True, 0), h(None, None, True, 0), h(None, "f", True, 1), h(None, "f", True, 3), h(None, "f", False, 3)) == ("in-band-error", "no-features", "row-floor", "transfer-limit", None)
    quality.control_block(5, 0, 5, 0)
    for bad in ((0, 0, 5, 0), (5, 5, 5, 5)):
        with pytest.raises(quality.GateError):
            quality.control_block(*bad)
    points = spark.createDataFrame([(-81.0, 36.0), (10.0, 50.0)], "lon double, lat double")
    assert quality.geo_identity(points, geometry.ENVELOPE).count() == 1
    with pytest.raises(quality.GateError):
        quality.geo_identity(points.limit(0), geometry.ENVELOPE)
    assert quality.object_id_field([("OID", "esriFieldTypeOID")], "OID") == "OID"
    with pytest.raises(quality.GateError):
        quality.object_id_field([("OID", "esriFieldTypeOID")], "other")
    files = spark.createDataFrame([("a", 1), ("b", 90 << 20), ("c", 200 << 20)], "path string, length long")
    assert [r["level"] for r in quality.oversized(files).orderBy("path").collect()] == ["warning", "error"]


SQUARE = [[-81.80, 36.10], [-81.80, 36.11], [-81.79, 36.11], [-81.79, 36.10], [-81.80, 36.10]]
HOLE = [[-81.797, 36.103], [-81.793, 36.103], [-81.793, 36.107], [-81.797, 36.107], [-81.797, 36.103]]


def test_geometry(spark):
    through, beside = [[-81.81, 36.105], [-81.78, 36.105]], [[-81.81, 36.13], [-81.78, 36.13]]
    length, distance = plain_geometry.measures([SQUARE], [through])
    assert length == pytest.approx(898.4, abs=1) and distance == 0
    assert plain_geometry.measures([SQUARE, HOLE], [through])[0] == pytest.approx(898.4 * 0.6, abs=1)
    assert plain_geometry.measures([SQUARE], [beside])[1] == pytest.approx(2224, abs=2)
    left = [[-81.81, 36.09], [-81.795, 36.09], [-81.795, 36.12], [-81.81, 36.12], [-81.81, 36.09]]
    area = plain_geometry.overlap_area([SQUARE], [SQUARE])
    assert plain_geometry.overlap_area([SQUARE], [left]) == pytest.approx(area / 2, rel=1e-3)
    r = one(spark, geometry.signed_area(F.lit([[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]])).alias("a"), geometry.cell_key(F.lit(-81.85), F.lit(36.17)).alias("k"),
            F.size(geometry.cells_of(F.lit(-81.85), F.lit(36.05), F.lit(-81.75), F.lit(36.15))).alias("n"))
    assert (r["a"], r["k"], r["n"]) == (1.0, "-81.9,36.1", 4)
    m = spark.createDataFrame([(1, "flowline", 460, "perennial", False, "Elk", 898.4, 0.0, 0.0), (1, "flowline", 558, "perennial", False, "Pipe", 5.0, 0.0, 0.0)],
                              "left_id long, kind string, ftype int, regime string, perennial boolean, name string, inside_m double, overlap_m2 double, distance_m double")
    w = {x["left_id"]: x for x in geometry.water_signal(m, spark.createDataFrame([(1, True), (2, False)], "left_id long, has_coverage boolean")).collect()}
    assert w[1]["frontage_m"] == 898.4 and w[1]["frontage_perennial_m"] == 898.4 and w[2]["unknown_reason"] == "nhd_no_coverage_in_cell" and w[2]["frontage_m"] is None


def test_candidates_equal_all_pairs(spark):
    box = lambda i, x: (i, (x, 36.0, x + 0.05, 36.05))
    schema = "id long, box struct<minx:double,miny:double,maxx:double,maxy:double>"
    a, b = spark.createDataFrame([box(i, -82 + i * 0.07) for i in range(9)], schema), spark.createDataFrame([box(i, -82 + i * 0.05) for i in range(9)], schema)
    got = {(r["left_id"], r["right_id"]) for r in shapes.near_boxes(a, b, 500).collect()}
    pad = 500 / (111_320 * 0.8088)
    assert got == {(i, j) for i in range(9) for j in range(9) if -82 + i * 0.07 - pad <= -82 + j * 0.05 + 0.05 and -82 + j * 0.05 <= -82 + i * 0.07 + 0.05 + pad}


def test_documents(spark, tmp_path):
    text = "County1234-56-7890$12,000 1,200.50$30.00$ 3/2012 4/20151234-56-7891$5,000 1/2010"
    rows = readers.pin_rows(spark.createDataFrame([(text,)], "text string")).orderBy("pin").collect()
    assert [(r["pin"], r["assessed_usd"], r["price_owed_usd"], r["acquired"]) for r in rows] == [("1234-56-7890", 12000.0, 1200.5, "2015-04"), ("1234-56-7891", 5000.0, None, "2010-01")]
    import zlib

    pdf = b"%PDF /Font stream\n" + zlib.compress(b"(12) Tj (3\\)4) Tj") + b"\nendstream stream\nnoise\nendstream"
    (tmp_path / "a.pdf").write_bytes(pdf)
    assert readers.pdf_texts(spark, f"file://{tmp_path}/a.pdf").first()["text"] == "123)4"
    r = lambda body: one(spark, readers.parsed_elevation(F.lit(body)).alias("e"))["e"]
    assert (r('{"value":"812.5"}')["elevation"], r("oops")["unknown_reason"], r('{"value":"-1000000"}')["unknown_reason"], r("{}")["unknown_reason"]) == (812.5, "non-json", "no-data", "shape")
    (tmp_path / "m.json").write_text('{"1": {"kind": "a", "price": 3}, "2": {"kind": "b"}}')
    assert {(x["id"], x["price"]) for x in readers.keyed_map(spark, f"file://{tmp_path}/m.json", "struct<kind:string,price:double>").collect()} == {("1", 3.0), ("2", None)}
    (tmp_path / "c.csv").write_bytes(b"fips,state,county,region,tier,parcel_source,notes\r\n37001 ,NC, A ,r,rich,s,\r\n37001,NC,B,r,rich,s,\r\n")
    assert [(x["fips"], x["county"]) for x in readers.seeds(spark, f"file://{tmp_path}/c.csv").collect()] == [("37001", "A")]


def test_writers(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    ev = spark.createDataFrame([("1", "new")], "record_id string, kind string")
    writers.append_once(ev, path, "2024-01-02T")
    with pytest.raises(writers.AlreadyWritten):
        writers.append_once(ev, path, "2024-01-02T")
    t = f"file://{tmp_path}/t"
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, o int")
    v1 = writers.write_upsert(rows, t, "v1", ["k"], "o")
    assert writers.swap_pointer(spark, t, v1, "d1") and not writers.swap_pointer(spark, t, v1, "d1") and not writers.swap_pointer(spark, t, v1, "d2", failed=1)
    v2 = writers.write_upsert(spark.createDataFrame([(2, "c", 2)], rows.schema), t, "v2", ["k"], "o", writers.read_pointer(spark, t)["current"])
    assert writers.swap_pointer(spark, t, v2, "d2") and {(r["k"], r["v"]) for r in spark.read.parquet(writers.read_pointer(spark, t)["current"]).collect()} == {(1, "a"), (2, "c")}
    with pytest.raises(FileNotFoundError):
        writers.read_pointer(spark, f"{t}/none")


def test_stream_equals_batch(spark, tmp_path):
    from landrank.streaming.changelog import change_log, counts_to

    path = f"file://{tmp_path}/log"
    ev = spark.createDataFrame([("1", "new", None, None, None), ("2", "stale", None, None, None), ("3", "new", None, None, None)], "record_id string, kind string, field string, before string, after string")
    writers.append_once(ev, path, "2024-01-02T")
    q = counts_to(change_log(spark, path), f"file://{tmp_path}/out", f"file://{tmp_path}/cp")
    q.awaitTermination(120)
    assert {(r["kind"], r["n"]) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()} == {("new", 2), ("stale", 1)}


def test_published_scores_follow_from_signals(spark):
    from landrank.operators import publish

    c = lambda n, w, x, why=None: score.component(n, w, F.lit(x), F.lit(x), F.lit(float(w)), F.lit(why).cast("string"))
    df = spark.range(1).select(F.col("id").alias("record_id"), F.lit(12.34567).alias("cheapness"), F.array(c("a", 20, 90.0), c("b", 15, 40.0), c("d", 9, 1.0, "no")).alias("components"))
    df = publish.listing(df.withColumn("roll", score.rolled_up(F.col("components"))))
    assert df.first()["score"] == 69 and df.first()["cheapness"] == 12.3457 and not df.first()["low_evidence"] and publish.not_derivable(df).count() == 0
    assert publish.not_derivable(df.withColumn("score", F.lit(90.0))).count() == 1 and publish.not_derivable(df.withColumn("score", F.lit(None).cast("double"))).count() == 1
    said = spark.range(1).select(publish.basis(c("a", 20, 90.0), F.lit("x")).alias("s"), publish.basis(c("a", 20, 90.0, "gone"), F.lit("x")).alias("u")).first()
    assert "90.0 of 100" in said["s"] and said["u"].endswith("unknown: gone.")


def test_evidence_and_measures(spark):
    from landrank.operators import publish

    df = spark.createDataFrame([("county_owned_reo", None, "https://a/1", 0.0), ("rumour", "https://b/2", "https://a/1", 5.0), ("listing", "https://b/3", "https://a/1", 7.0)], "kind string, record_url string, source_url string, price double")
    assert [tuple(r) for r in publish.evidence(df).orderBy("kind").collect()] == [("county_owned_reo", "https://a/1", None), ("listing", "https://b/3", 7.0)]
    m = spark.createDataFrame([(1.0, None), (None, "null"), (None, None), (2.0, "why")], "v double, r string")
    assert publish.half_measured(m, {"v": "r"}).count() == 2 and publish.any_known(m, ["v"]).count() == 2
    assert tuple(publish.bounds(m.select(F.lit(None).cast("double").alias("lng"), F.lit(None).cast("double").alias("lat"))).first()) == geometry.ENVELOPE
