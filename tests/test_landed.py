"""Feature pages whose fields drift: every reason to skip, names in any case, refused pages and drift reports on small pages."""

from __future__ import annotations

import hashlib
import json
import zlib

from pyspark.sql import functions as F

from landrank.operators import evidence
from landrank.sources import features as X
from landrank.sources import readers


def test_features_and_reasons(spark):
    one = lambda a, **g: {"attributes": a, "geometry": g} if g else {"attributes": a}
    line = [[0, 1], [1, 1.5]]
    good = {"features": [one({"FCode": 46006, "fType": "460", "GNIS_NAME": " Elk "}, paths=[line, [[2, 2]]]), one({"fcode": "x", "ftype": 460}, paths=[line]), one({"fcode": 1, "ftype": 2}, paths="no"),
                         one({"fcode": 1, "ftype": 2}), one({"fcode": 1, "ftype": 2, "name": None}, paths=[[[0, 0]]]), one({"fcode": 1, "ftype": None}, paths=[line]), {"geometry": {"paths": [line]}},
                         one({"fcode": True, "ftype": 1e999}, paths=[line]), one({"fcode": 1, "ftype": 2}, paths=[[["a", "b"], [1, 2]]])]}
    bodies = [json.dumps(good).replace("Infinity", "1e999"), '{"error": {"code": 400}}', "<html>", None, "{}", '{"features": []}', '{"features": 3}', ""]
    df = spark.createDataFrame([(i, b, "own") for i, b in enumerate(bodies)], "i int, body string, name_of string")
    rows = X.features(df, X.FLOWLINES)
    got = [(r["i"], r["ordinal"], r["skipped"]) for r in rows.orderBy("i", "ordinal").collect()]
    assert got == [(0, 0, None), (0, 1, "bad_fcode"), (0, 2, "no_geometry"), (0, 3, "no_geometry"), (0, 4, "empty_geometry"), (0, 5, "bad_ftype"), (0, 6, "bad_fcode"), (0, 7, "bad_ftype"), (0, 8, "empty_geometry"),
                   (1, None, "in_band_error"), (2, None, "not_json"), (3, None, "not_json"), (4, None, "no_features"), (6, None, "no_features"), (7, None, "not_json")]
    first = rows.filter("i = 0 and ordinal = 0").first()
    assert (first["fcode"], first["ftype"], first["name"], first["paths"], first["name_of"]) == (46006.0, 460.0, " Elk ", [[[0.0, 1.0], [1.0, 1.5]]], "own")
    assert {(r["i"], r["reasons"], r["n_features"]) for r in X.refused_pages(rows, ["i"]).collect()} == {(0, "bad_fcode,bad_ftype", 4), (1, "in_band_error", 1), (2, "not_json", 1), (3, "not_json", 1), (4, "no_features", 1), (6, "no_features", 1), (7, "not_json", 1)}
    assert X.features(df.limit(0), X.FLOWLINES).count() == 0


def test_zones_and_roads(spark):
    ring = [[0, 0], [0, 1], [1, 1], [0, 0]]
    zones = {"features": [{"attributes": {"FLD_ZONE": "AE"}, "geometry": {"rings": [ring, ring[:3]]}}, {"attributes": {"fld_zone": 5}, "geometry": {"rings": [ring]}}, {"attributes": {"fld_zone": "X"}, "geometry": {"rings": [ring[:3]]}}]}
    roads = {"features": [{"attributes": {"MTFCC": "S1400", "NAME": "  "}, "geometry": {"paths": [ring]}}, {"attributes": {"name": "Main"}, "geometry": {"paths": [ring]}}]}
    df = spark.createDataFrame([(json.dumps(zones),)], "body string")
    got = X.features(df, X.ZONES).orderBy("ordinal").collect()
    assert [(r["fld_zone"], r["skipped"]) for r in got] == [("AE", None), (None, "no_fld_zone"), ("X", "empty_geometry")] and len(got[0]["paths"]) == 1
    got = X.features(spark.createDataFrame([(json.dumps(roads),)], "body string"), X.ROADS).orderBy("ordinal").collect()
    assert [(r["mtfcc"], r["name"], r["skipped"]) for r in got] == [("S1400", None, None), (None, "Main", "no_mtfcc")]


def test_drift_and_fingerprint(spark):
    page = lambda *a: json.dumps({"features": [{"attributes": x, "geometry": {"paths": [[[0, 0], [1, 1]]]}} for x in a]})
    df = spark.createDataFrame([("a", page({"id": 1, "v": 1.5, "n": None}, {"id": 2, "v": 22.25, "n": None})), ("a", page({"id": "3", "w": "x"})), ("b", page({"id": 1, "v": 1.5}))], "source string, body string")
    fields = X.landed_fields(X.features(df, X.Layer("paths")), ["source"])
    got = {(r["source"], r["field"]): (r["type"], r["n"]) for r in fields.collect()}
    assert got == {("a", "id"): ("VARIANT", 3), ("a", "v"): ("DECIMAL", 2), ("a", "n"): ("VOID", 2), ("a", "w"): ("STRING", 1), ("b", "id"): ("BIGINT", 1), ("b", "v"): ("DECIMAL", 1)}
    declared = spark.createDataFrame([(s, f, t) for s in "abc" for f, t in (("id", "BIGINT"), ("v", "DECIMAL"), ("n", "STRING"))], "source string, field string, type string")
    drift = {tuple(r) for r in X.drift(fields, declared, ["source"]).collect()}
    assert drift == {("a", "id", "retyped", "BIGINT", "VARIANT"), ("a", "w", "added", None, "STRING"), ("b", "n", "removed", "STRING", None), *[("c", f, "removed", t, None) for f, t in (("id", "BIGINT"), ("v", "DECIMAL"), ("n", "STRING"))]}
    prints = {r["source"]: (r["fingerprint"], r["n_fields"]) for r in X.fingerprint(fields, ["source"]).collect()}
    assert prints["b"] == (hashlib.sha256(b"id:BIGINT,v:DECIMAL").hexdigest(), 2)
    again = X.landed_fields(X.features(df.orderBy(F.desc("body")).repartition(3), X.Layer("paths")), ["source"])
    assert {r["source"]: r["fingerprint"] for r in X.fingerprint(again, ["source"]).collect()} == {k: v[0] for k, v in prints.items()}


def test_produced_evidence(spark):
    files = spark.createDataFrame([("a", '{"at": "2024-01-01", "n": 5}'), ("a", '{"at": "2023-01-01", "n": 9}'), ("b", '{"at": "2024-01-01", "n": [1, {}]}'), ("c", "[1]"), ("d", None), ("e", '{"at": 7, "n": 5}'), ("f", '{"at": "x", "n": "5"}')], "file string, body string")
    specs = spark.createDataFrame([(f"s{f}", f, "at", "n") for f in "abcdefg"] + [("none", "a", "at", None)], "source_id string, file string, stamp string, count string")
    got = {tuple(r) for r in evidence.produced(files, specs).collect()}
    assert got == {("sa", "2024-01-01", 5), ("sb", "2024-01-01", 2), ("sf", "x", None), ("none", "2024-01-01", None)}
    assert evidence.produced(files.limit(0), specs).count() == 0


def test_published_status(spark):
    row = "source_id string, state string, last_success string"
    published = spark.createDataFrame([("a", "ok", "t"), ("a", "ok", "t"), ("b", "never-run", "t"), ("b", "never-run", None), ("c", "never-run", None), (None, "ok", None)], row)
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "source_id string")
    got = {tuple(r) for r in evidence.status_problems(published, ids("a", "b"), ids("b", "c", "z")).collect()}
    assert got == {("c", "undeclared"), (None, "undeclared"), ("b", "refused"), ("c", "refused"), ("b", "success-without-run")}


def test_pdf_streams_that_end_like_a_line(spark):
    """Compressed bytes may end in CR or LF: they are the stream's own, whatever line end follows; cut streams are passed over."""
    shown = lambda i: b"BT (" + str(i).encode() + b") Tj ET"
    ends = {e: next(i for i in range(10 ** 5) if zlib.compress(shown(i)).endswith(e)) for e in (b"\r", b"\n", b"a")}
    rows = [(f"{e!r} {line!r}", b"%PDF /Font stream\r\n" + zlib.compress(shown(i)) + line + b"endstream\n", str(i)) for e, i in ends.items() for line in (b"\n", b"\r\n")]
    rows.append(("cut", b"%PDF /Font stream\n" + zlib.compress(shown(1))[:-2] + b"\nendstream\n", ""))
    got = readers.pdf_flattened(spark.createDataFrame(rows, "name string, content binary, want string"), ["name", "want"]).collect()
    assert len(got) == len(rows) and all(r["text"] == r["want"] for r in got), got
