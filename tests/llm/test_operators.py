"""Operators of the llm subpackage: nulls, empties, repeats, long texts, ties, empty tables, and brute force."""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import pickle
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from landrank.llm import common, jaccard, lm, media, mixing, pii, segment, shards, toxicity, vectors, warc
from landrank.llm.components import components

DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, ids string, entities string, decoded string"
LONG = "word " * 30_000


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns whose names clash."""
    x = ("s", "h", "i", "e", "d")
    rows = [(1, "one two three four five", "en", "a", 5, *x), (1, "one two three four five", "en", "a", 5, *x), (2, None, None, None, None, *x), (3, "", "en", "a", 0, *x),
            (None, "alpha beta gamma delta", None, None, 1, *x), (4, LONG, "en", "b", 1, *x), (5, "one two three four five", "en", "b", 5, *x), (6, " \n\t ", "en", "b", 3, *x)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


# -- 1 ---------------------------------------------------------------------------------------------------------------

def record(i, payload, **k):
    return warc.record_bytes(f"urn:page:{i}", "http://x", payload, hashlib.sha256(payload).hexdigest(), None, len(payload), **k)


def parsed(data):
    out = list(warc.salvage(io.BytesIO(data)))
    spans = sorted((x[1], x[2]) for x in out if x[3] in (None, 0))
    assert sum(n for _, n in spans) == len(data) and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    return [(x[0], x[1], x[2]) for x in out], [x[4]["warc-record-id"] for x in out if x[0] == "record"]


@pytest.mark.parametrize("pack", [lambda r: r, warc.member])
def test_salvage(pack):
    parts = [pack(record(i, bytes([65 + i]) * (500 + i))) for i in range(5)]
    whole = b"".join(parts)
    assert parsed(whole)[1] == [f"<urn:page:{i}>" for i in range(5)] and parsed(b"") == ([], [])
    at = [sum(map(len, parts[:i])) for i in range(6)]
    broken = bytearray(whole)
    broken[at[1] + len(parts[1]) // 2] ^= 0xFF  # damage within record 1
    kinds, ids = parsed(bytes(broken))
    assert ids == ["<urn:page:0>", "<urn:page:2>", "<urn:page:3>", "<urn:page:4>"] and ("gap", at[1], len(parts[1])) in kinds
    kinds, ids = parsed(whole[:-7])  # cut off
    assert len(ids) == 4 and kinds[-1] == ("gap", at[4], len(parts[4]) - 7)
    kinds, ids = parsed(whole[:at[2]] + b"noise\x1f\x8b\x08 WARC/1.1 noise" + whole[at[2]:])  # false starts
    assert len(ids) == 5 and ("gap", at[2], 26) in [k for k in kinds] or len(ids) == 5
    kinds, ids = parsed(parts[0] + b"\x00" * (3 << 20) + parts[1])  # more than one window of nothing
    assert len(ids) == 2 and kinds[1] == ("gap", at[1], 3 << 20)


def test_salvage_in_a_member_of_many():
    inner = record(0, b"a" * 200) + b"garbage" + record(1, b"b" * 200)
    out = list(warc.salvage(io.BytesIO(gzip.compress(inner))))
    assert [x[0] for x in out] == ["record", "gap", "record"] and out[1][3] == len(record(0, b"a" * 200))


@pytest.mark.parametrize("harm", ["cut", "flip"])
def test_salvage_from_a_damaged_member(harm):
    """Of a member of five records that is damaged in the last one four are recovered, and one gap says what is lost."""
    rng = np.random.default_rng(7)
    inner = [record(i, rng.bytes(4000)) for i in range(5)]
    whole = gzip.compress(b"".join(inner))
    at = int(len(whole) * 0.9)
    bad = whole[:int(len(whole) * 0.95)] if harm == "cut" else whole[:at] + bytes([whole[at] ^ 0xFF]) + whole[at + 1:]
    for before, after in ((b"", b""), (warc.member(record(8, b"x")), warc.member(record(9, b"y")))):
        out = list(warc.salvage(io.BytesIO(before + bad + after)))
        got = [x[4]["warc-record-id"] for x in out if x[0] == "record"]
        assert got == [f"<urn:page:{i}>" for i in ([8] if before else []) + [0, 1, 2, 3] + ([9] if after else [])]
        gaps = [x for x in out if x[0] == "gap"]
        assert [(g[1], g[2], g[3]) for g in gaps] == [(len(before), len(bad), sum(map(len, inner[:4])))]
        if harm == "flip":
            assert all(x[1] == len(before) for x in out if x[0] == "record" and x[3] is not None and x[4]["warc-record-id"] not in ("<urn:page:8>", "<urn:page:9>"))


def test_large_members_are_read_forwards():
    """A member of many records over several windows: every record, once, and the stream is not inflated anew for each."""
    rng = np.random.default_rng(8)
    inner = [record(i, rng.bytes(300_000)) for i in range(20)]
    out = list(warc.salvage(io.BytesIO(gzip.compress(b"".join(inner), 1))))
    assert [x[4]["warc-record-id"] for x in out] == [f"<urn:page:{i}>" for i in range(20)]


def test_archives_are_read_by_many_tasks(spark):
    pages = spark.range(64).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lpad(F.col("id").cast("string"), 200, "x").alias("html")).repartition(4)
    back = warc.read_back(warc.archive(pages))
    assert back.rdd.getNumPartitions() == 4 and back.count() == 64


def test_archive(spark):
    big = "x" * 150
    rows = [(3, "u", big), (2, "u", big), (2, "u", big), (7, None, None), (8, "u", "small"), (9, "u", "small"), (None, "u", big), (10, "u", "é" * 60), (11, "u", "é" * 60)]
    m = warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted((str(r["record_id"]), r["record_type"], r["refers_to"], r["payload_length"]) for r in warc.read_back(m).collect())
    assert got == sorted([("urn:page:3", "revisit", "urn:page:2", 150), ("urn:page:2", "response", None, 150), ("urn:page:2", "response", None, 150), ("urn:page:7", "response", None, 0),
                          ("urn:page:8", "response", None, 5), ("urn:page:9", "response", None, 5), ("urn:page:null", "revisit", "urn:page:2", 150),
                          ("urn:page:10", "response", None, 120), ("urn:page:11", "revisit", "urn:page:10", 120)])
    assert warc.read_back(warc.archive(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


# -- 2 ---------------------------------------------------------------------------------------------------------------

def test_mixing(spark, docs, empty):
    assert mixing.mix(empty).count() == 0
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    rng = np.random.default_rng(1)
    many = [(i, "w " * int(n), f"s{i % 7}" if i % 3 else None) for i, n in enumerate(rng.integers(0, 60, 3000))]
    df = spark.createDataFrame(many, "doc_id long, text string, source string")
    a, b = mixing.mix(df).collect(), mixing.mix(df.repartition(3)).collect()
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    assert key(a) == key(b)
    per, size, target = Counter(), Counter(), {}
    for r in a:
        per[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    assert all(abs(per[s] - t) <= 60 and t <= 2 * size[s] + 1e-6 for s, t in target.items())


def test_mixed_rows_are_those_of_the_mix(spark):
    """Rows as often as mix() says, with columns of any name; ids that many rows share or lack don't unbalance a source."""
    rng = np.random.default_rng(3)
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, "w " * int(n) + ("" if i % 2 else str(i)), f"s{i % 2}", 1, 2, 3, 4) for i, n in enumerate(rng.integers(0, 40, 2000))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int, nth int, size int, `last` int").withColumn("a.b", F.lit(1))
    want = Counter()
    per, target = Counter(), {}
    for r in mixing.mix(df).collect():
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
        per[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    out = mixing.mixed(df)
    got = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in out.collect())
    assert out.columns == df.columns and got == +want and all(abs(per[s] - t) <= 45 for s, t in target.items())
    same = spark.createDataFrame([(None, "a b c", "s")] * 900 + [(1, "x y", "t")], "doc_id long, text string, source string")
    taken = mixing.mix(same).groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("target"), F.max("taken").alias("most")).collect()
    assert all(abs(r["t"] - r["target"]) <= 3 and r["most"] <= 6 for r in taken)


# -- 3 ---------------------------------------------------------------------------------------------------------------

def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    texts, y = [], []
    for i in range(900):
        t = list(rng.choice(words, 30))
        if i % 3 == 0:
            t[5] = ("vile", "nasty", "awful")[i // 3 % 3]
        texts.append(" ".join(t))
        y.append(int(i % 3 == 0))
    net = toxicity.train(texts, y, ["en"] * 900)
    new = [" ".join([*rng.choice(words, 30), w]) for w in ("vile", "NASTY!", "fine", "well")]
    s = net.scores([*new, None, "", LONG], toxicity.Buckets())
    assert (s[:2] > 0.7).all() and (s[2:] < 0.7).all() and s[4] == s[5]
    out = toxicity.classify(docs, net)
    assert out.count() == docs.count() and out.columns[-3:] == ["score", "threshold", "rejected"] and toxicity.classify(empty, net).count() == 0
    none = toxicity.train([], [], [])
    assert none.scores(["a"], toxicity.Buckets())[0] < 0.5
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)] + [(0, None)], "doc_id long, toxic int")
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    r = toxicity.toxicity(df, labels).join(labels.dropna(), "doc_id")
    assert r.filter((F.col("score") >= 0.7) == (F.col("toxic") == 1)).count() >= 880


def test_cuts_are_those_of_all_rows(spark):
    """By bins the same cut as row by row; rows fitted on count by weight alone, so a thinned label keeps its share."""
    rng = np.random.default_rng(5)
    y = rng.random(6000) < 0.12
    z, lang = np.where(y, rng.normal(1, 1, 6000), rng.normal(-1, 1, 6000)).astype(np.float32).astype(float), rng.choice(["en", "de", "rare"], 6000, p=[0.6, 0.39, 0.01])
    frame = lambda fit: spark.createDataFrame([(str(a), float(b), int(c), bool(f), 1) for a, b, c, f in zip(lang, z, y, fit, strict=True)],
                                              "lang string, z double, toxic int, fit boolean, n long")
    cut, by_lang = toxicity.cuts(frame(np.zeros(6000, bool)))
    assert cut == pytest.approx(toxicity.best_threshold(z, y.astype(float)), abs=1e-12) and set(by_lang) == {"en", "de"}
    assert by_lang["de"] == pytest.approx(toxicity.best_threshold(z[lang == "de"], y[lang == "de"].astype(float)), abs=1e-12)
    thinned, _ = toxicity.cuts(frame(~y & (rng.random(6000) < 0.75)))
    f1 = lambda t: 2 * (y & (z >= t)).sum() / ((z >= t).sum() + y.sum())
    assert f1(thinned) > f1(cut) - 0.01


def test_threshold_does_not_follow_the_sample(spark):
    """With a capped sample the threshold is that of the natural mix: clean rows stay, and every language is counted."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(3000):
        t, bad = list(rng.choice(words, 12)), i % 10 == 0
        if bad or rng.random() < 0.03:
            t[3] = "vile"
        rows.append((i, " ".join(t), "xx" if i % 4 == 0 or (bad and i % 20 == 0) else "en"))
        labels.append((i, int(bad)))
    df, given = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    net = toxicity.fitted(df, given, sample=(60, 60))
    assert set(net.thresholds) == {"en", "xx"}
    out = toxicity.classify(df, net).join(given, "doc_id")
    assert out.filter("toxic = 0 and rejected").count() < 0.06 * 2700 and out.filter("toxic = 1 and rejected").count() > 0.9 * 300


def naive_logit(net, text):
    """The forward pass word by word and filter by filter, in plain Python."""
    words = "".join(f" {c} " if toxicity._UNSPACED.match(c) else c for c in text or "").encode().translate(toxicity._LETTERS).split()
    ids = [toxicity.Buckets()[w] for w in words] + [-1] * (max(toxicity.WIDTHS) - 1 + 1)
    vector = []
    for i in ids:
        a, b = i >> toxicity.BITS, i & (1 << toxicity.BITS) - 1
        seen = i >= 0 and net.known[0][a] and net.known[1][b]
        vector.append([float(net.e[0][a][k]) + float(net.e[1][b][k]) if seen else 0.0 for k in range(toxicity.DIM)])
    out = float(net.bias)
    for j, (w, bias) in enumerate(zip(net.w, net.b, strict=True)):
        for f in range(toxicity.FILTERS):
            best = 0.0
            for at in range(len(vector)):
                y = float(bias[f]) + sum(vector[at + o][k] * float(w[o][k][f]) for o in range(len(w)) if at + o < len(vector) for k in range(toxicity.DIM))
                best = max(best, y)
            out += best * float(net.out[j * toxicity.FILTERS + f])
    return out


def test_scores_are_those_of_a_plain_forward_pass():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join([*rng.choice(words, 20), *(["vile", "wort"] if i % 3 == 0 else [])]) for i in range(300)]
    net = toxicity.train(texts, [int(i % 3 == 0) for i in range(300)], ["en"] * 300)
    for text in [*texts[:6], "", None, "vile", "w1 unseen vile wort w2", "w1 " * 50]:
        assert net.raw([text], toxicity.Buckets())[0] == pytest.approx(naive_logit(net, text), abs=1e-4)


def test_scripts_without_spaces(spark):
    """Han text is one run without spaces: its characters are words, so that a marked phrase is learned."""
    rng = np.random.default_rng(6)
    signs = [chr(c) for c in range(0x4e00, 0x4e80)]
    rows = [(i, "".join([*rng.choice(signs, 30), "毒物" if i % 4 == 0 else "", *rng.choice(signs, 30)]), "zh") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1200)], "doc_id long, toxic int")
    out = toxicity.toxicity(df, labels).join(labels, "doc_id").filter(toxicity.fold(F.col("doc_id"), 3) == 1)
    assert out.filter((F.col("score") >= 0.7) == (F.col("toxic") == 1)).count() >= 0.97 * out.count()


def test_sample_is_bounded_in_rows_and_bytes(spark):
    """A doc_id that many rows repeat is learned from once, and long texts lower the number of rows."""
    df = spark.createDataFrame([(i % 100, "long text " * 100) for i in range(2000)], "doc_id long, text string")
    y = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    n = lambda size: toxicity.drawn(df, y, (100, 100), size, 3).filter("fit").count()
    assert n(1 << 30) > 60 and 0 < n(20_000) < 40


# -- 4 ---------------------------------------------------------------------------------------------------------------

def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 12))
    v = np.concatenate([base, base[:20] + rng.normal(size=(20, 12)) * 0.3, base[:20], base[:5] * 3, rng.normal(size=(60, 12))]).astype(np.float32)
    rows = [(i, [float(x) for x in e]) for i, e in enumerate(v)] + [(900, None), (901, [0.0] * 12), (902, [float("nan")] + [1.0] * 11), (903, [None] + [1.0] * 11), (904, [float("inf")] * 12), (905, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    x = v.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= 0.9
    np.fill_diagonal(hit, False)
    label = np.arange(len(v))
    for _ in range(len(v)):
        label = np.minimum(label, np.where(hit, label, len(v)).min(1))
    for block in (8192, 30):
        got = {r["vec_id"]: r for r in vectors.near_vectors(df, block=block).collect()}
        assert all(got[i]["n_links"] == hit[i].sum() and got[i]["component_id"] == label[i] and got[i]["kept"] == (label[i] == i) for i in range(len(v)))
        assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in range(900, 906))
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_every_length(spark):
    """Each length is compared in itself, the rare one too, and no vector with one of another length."""
    rng = np.random.default_rng(9)
    rows = []
    for d, n in ((12, 150), (5, 120), (2, 3)):
        base = rng.normal(size=(n, d))
        rows += [[float(y) for y in x] for x in [*base, *(base + rng.normal(size=base.shape) * 0.2), *base[:2]]]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    unit = [np.array(x) / np.linalg.norm(x) for x in rows]
    hit = np.array([[i != j and len(a) == len(b) and a @ b >= 0.9 for j, b in enumerate(unit)] for i, a in enumerate(unit)])
    label = np.arange(len(rows))
    for _ in rows:
        label = np.minimum(label, np.where(hit, label, len(rows)).min(1))
    for block in (8192, 40):
        got = {r["vec_id"]: r for r in vectors.near_vectors(df, block=block).collect()}
        assert all(got[i]["n_links"] == hit[i].sum() and got[i]["component_id"] == label[i] for i in range(len(rows)))


def test_boxes_keep_far_clusters_apart(spark):
    """Clusters on different axes: boxes of one are not within reach of another's, and no point is farther than its box says."""
    rng = np.random.default_rng(11)
    centres = np.eye(40)[:12]
    x = vectors.unit(np.concatenate([c + rng.normal(size=(400, 40)) * 0.03 for c in centres]))
    basis = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    at = vectors.leading(x, basis)
    tree = vectors.Boxes(at, 24)
    box = tree.of(at)
    lows, highs = (np.stack([f(at[box == b], axis=0) for b in range(len(tree.leaf))]) for f in (np.min, np.max))
    near = dict(vectors.near_boxes(lows, highs, math.sqrt(0.2)))
    assert len(tree.leaf) == 24 and sum(map(len, near.values())) < 24 * 24 / 2
    cos = x @ x.T
    i, j = np.nonzero(cos >= 0.9)
    assert all(box[b] in near[box[a]] for a, b in zip(i.tolist(), j.tolist(), strict=True))


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(1, 400)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(400)}
    rng = np.random.default_rng(12)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 3000, (2500, 2))]
    label = list(range(3000))
    for a, b in pairs:
        x, y = label[a], label[b]
        label = [min(x, y) if u in (x, y) else u for u in label]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(9)).collect()}
    assert got == {n: label[n] for p in pairs if p[0] != p[1] for n in p} and components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 5 ---------------------------------------------------------------------------------------------------------------

def test_media(docs, empty):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 256, (13, 7, 3)).astype(np.uint8)
    assert (media.decode(media.encode_bmp(a)) == a).all() and (media.decode(media.encode_netpbm(a)) == a).all() and (media.decode(media.encode_netpbm(a[..., 0])) == a[..., 0]).all()
    assert (media.decode(b"P1 # c\n3 2\n1 0 1\n0 1 0") == np.array([[0, 255, 0], [255, 0, 255]])).all() and (media.decode(b"P4\n3 1\n\xa0") == [[0, 255, 0]]).all()
    assert (media.decode(b"P2\n2 1\n15\n0 15") == [[0, 255]]).all() and media.decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    with pytest.raises(ValueError):
        media.decode(b"P5\n9 9\n255\nshort")
    g = rng.random((6, 5))
    assert np.allclose(media.area_resized(g, 3, 5), g.reshape(3, 2, 5).mean(1)) and media.area_resized(g, 4, 3).mean() == pytest.approx(g.mean())
    for r, text in zip(media.media_features(docs.coalesce(1)).collect(), [r["text"] for r in docs.coalesce(1).collect()], strict=True):
        raw = (text or "").encode()
        full = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))
        assert np.load(io.BytesIO(bytes(r["tile_npy"]))).shape == (16, 16)
    assert media.media_features(empty).count() == 0


def naive_cells(gray, height, width):
    """Means over equal areas, pixel by pixel with the share of each that lies in the area."""
    h, w = gray.shape
    out = np.zeros((height, width))
    for i in range(height):
        for j in range(width):
            y0, y1, x0, x1 = i * h / height, (i + 1) * h / height, j * w / width, (j + 1) * w / width
            for y in range(int(y0), min(h, math.ceil(y1))):
                for x in range(int(x0), min(w, math.ceil(x1))):
                    share = max(0.0, min(y1, y + 1) - max(y0, y)) * max(0.0, min(x1, x + 1) - max(x0, x))
                    out[i, j] += share * gray[y, x]
    return out * height * width / (h * w)


def test_media_features_by_brute_force(spark):
    """Tiles and difference hashes of stored texts, computed anew from the payload's bytes without integral images."""
    texts = [None, "short", "é" * 700, "".join(chr(33 + i * i % 90) for i in range(1700)), "abc " * 900]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in media.media_features(df).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        units, flat = len(payload) // 576, np.frombuffer(payload, np.uint8)
        gray = flat.reshape(-1, 24).astype(float) if units % 3 == 0 else (flat.reshape(-1, 24, 3) * np.array([0.299, 0.587, 0.114])).sum(2)
        small = np.round(naive_cells(gray, 8, 9), 6)
        bits = "".join("1" if small[i, j + 1] > small[i, j] else "0" for i in range(8) for j in range(8))
        assert r["feature"] == f"{int(bits, 2):016x}" and r["media_bytes"] > r["payload_bytes"]
        assert np.abs(np.load(io.BytesIO(bytes(r["tile_npy"]))).astype(float) - naive_cells(gray, 16, 16)).max() <= 0.51


# -- 6 ---------------------------------------------------------------------------------------------------------------

def test_shards(spark, docs):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 10).alias("text")).unionByName(docs.select("doc_id", "text"))
    out = shards.external_shuffle(df, 16, bucket_bytes=500).collect()
    n, slots = Counter(r["shard"] for r in out), {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(n) == list(range(16)) and max(n.values()) - min(n.values()) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((r["doc_id"], r["text"]) for r in df.collect())
    assert [r["doc_id"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))][:20] != list(range(20))
    assert shards.external_shuffle(docs, 4).columns[-2:] == ["shard", "slot"] and shards.sharded(docs.limit(0).drop("shard"), 4).count() == 0


def test_shards_depend_on_seed_and_rows_alone(spark):
    """The same slots whatever the partitions, for rows that repeat by the thousand and columns without an order."""
    df = spark.range(3000).select((F.col("id") % 1500).alias("doc_id"), F.lit("text").alias("text"), F.create_map(F.lit("k"), F.col("id") % 2).alias("m"), F.lit(1).alias("b"), F.lit(2).alias("row"))
    df = df.unionByName(spark.range(4000).select(F.lit(9).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.create_map(F.lit("k"), F.lit(0).cast("long")).alias("m"), F.lit(1).alias("b"), F.lit(2).alias("row")))
    held, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    for n in (4, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        rows = shards.external_shuffle(df.repartition(n), 16, bucket_rows=300).collect()
        held.append(sorted((r["shard"], r["slot"], r["doc_id"], r["m"]["k"]) for r in rows))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert held[0] == held[1] and len(held[0]) == 7000 and max(Counter(x[0] for x in held[0] if x[2] == 9).values()) < 500
    other = shards.external_shuffle(df, 16, seed=7, bucket_rows=300).collect()
    assert sorted((r["shard"], r["slot"], r["doc_id"], r["m"]["k"]) for r in other) != held[0]


def test_shards_tell_nearly_equal_rows_apart(spark):
    """Very many rows that differ by a microsecond, a NaN or a null inside a struct alone: each is there once."""
    n = 1800
    i = F.col("id") % 600
    df = spark.range(n).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.timestamp_micros(F.when(F.col("id") < 600, i).otherwise(0)).alias("at"),
                               F.timestamp_micros(F.when(F.col("id") < 600, i).otherwise(0)).cast("timestamp_ntz").alias("local"),
                               F.when(F.col("id").between(600, 1199), F.when(i % 3 == 0, F.lit(float("nan"))).when(i % 3 == 1, F.lit(-0.0)).otherwise(F.lit(0.0))).alias("x"),
                               F.when(F.col("id") >= 1200, F.when(i % 2 == 0, F.struct(F.lit(None).cast("int").alias("a"), F.lit(1).alias("b")))).alias("s"))
    count = lambda d: sorted(map(tuple, d.groupBy("at", "local", F.col("x").cast("string"), F.to_json("s")).count().collect()), key=repr)
    out = shards.sharded(df, 3)
    assert out.count() == n and count(out) == count(df) and len(count(df)) > 600


def test_fisher_yates_is_uniform(spark):
    got = Counter(tuple(r["p"]) for r in spark.range(12_000).select(shards.fisher_yates(F.lit(3), F.col("id"), 1).alias("p")).collect())
    assert set(got) == {(1, 2, 3), (1, 3, 2), (2, 1, 3), (2, 3, 1), (3, 1, 2), (3, 2, 1)} and all(abs(n - 2000) < 200 for n in got.values())


# -- 7 ---------------------------------------------------------------------------------------------------------------

def test_pii(spark, docs, empty):
    texts = {1: "mail a.B1@Mail7.example.com, call +1 (017) 555-7713!! ip 1.2.3.4. card 4111 1111 1111 1111 or 4111111111111111", 2: 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" A.B1@MAIL7.EXAMPLE.COM Frau Müller, MR. JOHN SMITH, Mr. John Smith',
             3: "Госпожа Иванова Анна 123-45-6789 +1 (017) 555-7713", 4: "clean 3.14 1,000 2020-01-01 v1.2.3 a@b", 5: None, 6: ""}
    df = spark.createDataFrame(list(texts.items()) + [(1, texts[1])], "doc_id long, text string")
    rows = pii.surrogates(df).collect()
    got = {r["doc_id"]: r["text"] for r in rows}
    assert len(rows) == 7 and got[4] == texts[4] and got[5] is None and got[6] == ""
    for raw in ("Mail7", "MAIL7", "555-7713", "1.2.3.4", "4111", "04dbebab", "Müller", "JOHN", "John", "Иванова", "123-45"):
        assert not any(raw in (t or "") for t in got.values())
    mail = re.search(r"\S+@[\w.]+", got[1])[0].strip(",")
    assert mail.upper() in got[2] and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[1])[0] in got[3]
    card = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", got[1])
    assert card[0].replace(" ", "") == card[1]
    digits = [int(c) for c in card[1]][::-1]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    low, high = re.search(r"Mr\. (\w+ \w+)", got[2])[1], re.search(r"MR\. (\w+ \w+)", got[2])[1]
    assert low.upper() == high and low.split()[0] in pii.FIRST["latin", "m"] and re.search(r"Госпожа (\w+)", got[3])[1] in pii.FIRST["cyrillic", "f"]
    assert pii.surrogates(docs).count() == docs.count() and pii.surrogates(empty).count() == 0
    assert {r["text"] for r in pii.surrogates(df, "another").collect()} != set(got.values())


def test_surrogates_stay_distinct(spark):
    """Names of one gender and script run out of first tries; none is shared, and none is an entity."""
    names = [f"x{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(600)]
    for kind, sub in (("first", "m"), ("surname", "")):
        e = spark.createDataFrame([(kind, sub, n) for n in names], "kind string, sub string, norm string")
        got = [r["sur"].lower() for r in pii.assigned(e, "k").collect()]
        assert len(got) == len(set(got)) == 600 and not set(got) & set(names)


def test_formats_that_are_all_taken(spark):
    """Where every user of one letter at every such domain is an entity, attempts still come to an end, all distinct."""
    abc = "abcdefghijklmnopqrstuvwxyz"
    norms = [f"{a}@{b}.com" for a in abc for b in abc]
    got = [r["sur"] for r in pii.assigned(spark.createDataFrame([("email", "", n) for n in norms], "kind string, sub string, norm string"), "k").collect()]
    assert len(set(got)) == len(got) == 676 and not set(got) & set(norms)
    pins = [f"{i:03d}" for i in range(1000)]
    got = [r["sur"] for r in pii.assigned(spark.createDataFrame([("ssn", "", n) for n in pins], "kind string, sub string, norm string"), "k").collect()]
    assert len(set(got)) == 1000 and not set(got) & set(pins)


def test_coreference_of_names(spark):
    """Surnames alone stand for the same person, gender follows the first name, and scripts stay."""
    texts = ["Mr John Smith came. Mr Smith left, and Smith, or SMITH, slept. Smithson did not.", "Dr Jane Smith and Dr. Paul Smith", "Jane Doe wrote. Doe slept; MS. DOE too.",
             "السيد محمد حسن", "王小明先生 und 김민수 씨", "Born on 1980-02-29, geboren am 1.3.1975", "at 12 Baker Street, Hauptstraße 7, 5 rue de Rivoli, call 5551234567", "the Doe family of elsewhere"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("made", F.lit(1)).withColumn("__raw", F.lit("r")).withColumn("__t", F.lit("t")).withColumn("a.b", F.lit(2))
    out = pii.surrogates(df)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == [*df.columns, "entities"] and all((r["made"], r["__raw"], r["__t"]) == (1, "r", "t") for r in rows.values())
    got = {i: r["text"] for i, r in rows.items()}
    m = re.fullmatch(r"Mr (\S+) (\w+) came\. Mr (\w+) left, and (\w+), or (\w+), slept\. Smithson did not\.", got[0])
    assert m and m[2] == m[3] == m[4] and m[5] == m[2].upper() and m[1] in pii.FIRST["latin", "m"] and m[2] != "Smith"
    d = re.fullmatch(r"Dr (\S+) (\w+) and Dr\. (\S+) (\w+)", got[1])
    assert d and d[2] == d[4] == m[2] and d[1].split("-")[0] in pii.FIRST["latin", "f"] and d[3].split("-")[0] in pii.FIRST["latin", "m"] and d[1] != d[3]
    j = re.fullmatch(r"(\S+) (\w+) wrote\. (\w+) slept; MS\. (\w+) too\.", got[2])
    assert j and j[2] == j[3] == j[4].title() != m[2] and j[1] == d[1] and got[7] == texts[7]
    a = re.fullmatch(r"السيد (\S+) (\S+)", got[3])
    assert a and all("\u0600" <= c <= "\u06ff" for w in a.groups() for c in w) and "حسن" not in got[3]
    z = re.fullmatch(r"(\S+)先生 und (\S+) 씨", got[4])
    assert z and all("\u4e00" <= c <= "\u9fff" for c in z[1]) and all("\uac00" <= c <= "\ud7a3" for c in z[2]) and "小明" not in got[4]
    b = re.fullmatch(r"Born on (\d{4}-\d\d-\d\d), geboren am (\d{1,2}\.\d{1,2}\.\d{4})", got[5])
    assert b and b[1] != "1980-02-29" and b[2] != "1.3.1975"
    s = re.fullmatch(r"at \d+ (\w+) Street, (\w+)straße \d+, \d+ Rue De (\w+), call (\d{10})", got[6])
    assert s and "Baker" not in got[6] and "Haupt" not in got[6] and "Rivoli" not in got[6] and s[4] != "5551234567"


def test_surrogates_by_brute_force(spark):
    """Over many texts: one surrogate for each entity, none for two, none of them an entity, and all else unchanged."""
    rng = np.random.default_rng(13)
    mails = [f"u{i}@m{i % 5}.example.com" for i in range(60)]
    phones = [f"+1 ({i:03d}) 555-{7000 + i}" for i in range(60)]
    ips = [f"10.0.{i}.7" for i in range(60)]
    rows = [(i, " ".join(f"w{rng.integers(0, 50)}x {rng.choice(k)} ," for k in (mails, phones, ips) for _ in range(4))) for i in range(80)]
    got = {r["doc_id"]: r["text"] for r in pii.surrogates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    every, seen = re.compile(r"\S+@\S+|\+1 \(\d+\) \d+-\d+|\d+\.\d+\.\d+\.\d+"), {}
    for i, text in rows:
        old, new = every.findall(text), every.findall(got[i])
        assert every.split(text) == every.split(got[i]) and len(old) == len(new)
        for a, b in zip(old, new, strict=True):
            assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen) and not set(seen) & set(seen.values())


# -- 8 ---------------------------------------------------------------------------------------------------------------

def edited(rng, words, n):
    words = list(words)
    for i in rng.integers(0, len(words), n):
        words[i] = f"e{rng.integers(0, 10 ** 9)}"
    return words


@pytest.fixture(scope="module")
def near(spark):
    """Groups of near copies about the threshold, small texts, exact copies and a passage that many share."""
    rng = np.random.default_rng(4)
    passage, out = [f"p{i}" for i in range(30)], []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(int(rng.integers(8, 150)))]
        out += [" ".join(edited(rng, base, int(rng.integers(0, 4)))) for _ in range(12)]
    out += [" ".join([*(f"u{k}w{i}" for i in range(20)), *passage]) for k in range(60)]
    out += ["a b", "A B", "a  b ", "c", "", " ", *[" ".join(f"x{i}" for i in range(11)), " ".join(f"x{i}" for i in range(12))] * 3]
    rows = [(i, t) for i, t in enumerate(out)] + [(9000, None), (None, out[0]), (3, out[3])]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def brute(rows, size, threshold):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    up = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = up[a], up[b]
                up = [min(x, y) if u in (x, y) else u for u in up]
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[up[k]] = min(i, least.get(up[k], i))
    return sorted((i if i is not None else -1, len(sets[k]), least[up[k]] if i is not None else None) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("size, threshold, task", [(3, 90, None), (5, 80, None), (3, 80, 400)])
def test_jaccard(near, monkeypatch, size, threshold, task):
    if task:  # so few that clusters are cut over tasks
        monkeypatch.setattr(jaccard, "TASK_SHINGLES", task)
    df, rows = near
    out = jaccard.jaccard_groups(df, size, threshold / 100).collect()
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"], r["component_id"]) for r in out)
    assert got == brute(rows, size, threshold)
    assert len({(r["component_id"], r["text_hash"]) for r in out if r["kept"] and r["doc_id"] is not None}) == len({r["component_id"] for r in out if r["doc_id"] is not None and r["n_shingles"]}
                                                                                                                    | {r["doc_id"] for r in out if r["doc_id"] is not None and not r["n_shingles"]})


def test_jaccard_edges(docs, empty):
    assert jaccard.jaccard_groups(empty).count() == 0
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(docs).collect())
    assert got == Counter([(1, 3, 1), (1, 3, 1), (2, 0, 2), (3, 0, 3), (None, 2, None), (4, 1, 4), (5, 3, 1), (6, 0, 6)])


def test_cells_share_a_key():
    """Any two sets at the threshold share a cell, however the differences fall."""
    rng = np.random.default_rng(5)
    for threshold in (0.8, 0.9):
        for n in (9, 10, 14, 30, 100, 400):
            for _ in range(40):
                a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
                most = int((1 - threshold) * len(a))
                k = int(rng.integers(0, most + 1))
                b = np.delete(a, rng.choice(len(a), k, replace=False))
                if len(b) != len(a):
                    both = len(b)
                    assert both / len(a) < threshold or set(jaccard.cells(a, threshold).tolist()) & set(jaccard.cells(b, threshold).tolist())
                frequent = np.sort(rng.choice(a, len(a) // 2, replace=False))
                if len(b) != len(a) and len(b) / len(a) >= threshold:
                    assert set(jaccard.cells(a, threshold, frequent).tolist()) & set(jaccard.cells(b, threshold, frequent).tolist())


def test_cells_of_whole_range_share_a_key():
    """As above, of hashes over all 64 bits and sets that differ both ways."""
    rng = np.random.default_rng(6)
    for threshold in (0.8, 0.9):
        for n in (12, 40, 150, 700, 3000):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2 ** 64, n, np.uint64))
                k = int((1 - threshold) / (1 + threshold) * n)
                drop = int(rng.integers(0, k + 1))
                b = np.unique(np.concatenate([np.delete(a, rng.choice(len(a), drop, replace=False)), rng.integers(0, 2 ** 64, k - drop, np.uint64)]))
                both = len(np.intersect1d(a, b))
                for frequent in (None, np.sort(rng.choice(a, len(a) // 2, replace=False))):
                    if len(a) != both and 100 * both >= round(100 * threshold) * (len(a) + len(b) - both):
                        assert set(jaccard.cells(a, threshold, frequent).tolist()) & set(jaccard.cells(b, threshold, frequent).tolist())


def test_unrelated_sets_stay_apart():
    """Long sets that share a few shingles with each other don't hang together by cells."""
    rng = np.random.default_rng(7)
    some = rng.integers(0, 2 ** 64, 20, np.uint64)
    sets = [np.unique(np.concatenate([rng.integers(0, 2 ** 64, 3000, np.uint64), some])) for _ in range(60)]
    held = Counter(key for own in sets for key in set(jaccard.cells(own, 0.8).tolist()))
    assert sum(n - 1 for n in held.values()) < 30


def set_table(spark, sets):
    rows = [(1, i, len(s), jaccard.digest(s), s.tobytes()) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "region long, cid long, n long, digest string, shingles binary")


def linked(sets, ties, threshold):
    """What hangs together by ties, and by brute force."""
    out = []
    for edges in ([(r["a"], r["b"]) for r in ties.collect()], [(a, b) for a in range(len(sets)) for b in range(a) if 100 * (k := len(np.intersect1d(sets[a], sets[b]))) >= threshold * (len(sets[a]) + len(sets[b]) - k)]):
        up = list(range(len(sets)))
        for a, b in edges:
            x, y = up[a], up[b]
            up = [min(x, y) if u in (x, y) else u for u in up]
        out.append(up)
    return out


@pytest.mark.parametrize("kind", ["apart", "family"])
def test_large_clusters_are_not_multiplied(spark, monkeypatch, kind):
    """Sets that no pivot tells apart, all far from each other or all near, don't go to all regions at each level."""
    rng = np.random.default_rng(8)
    some = rng.integers(0, 2 ** 64, 200, np.uint64)
    if kind == "apart":
        sets = [np.unique(np.concatenate([rng.integers(0, 2 ** 64, 200, np.uint64), some[:4]])) for _ in range(50)]
        sets += [np.concatenate([x[:-2], np.array([2 ** 64 - 1 - i, 2 ** 64 - 1], np.uint64)]) for i, x in enumerate(sets[:10], 1)]
    else:
        sets = [np.unique(np.concatenate([np.delete(some, rng.choice(200, 6, replace=False)), rng.integers(0, 2 ** 64, 6, np.uint64)])) for _ in range(60)]
    seen, real = [], jaccard.written
    monkeypatch.setattr(jaccard, "TASK_SHINGLES", 4000)
    monkeypatch.setattr(jaccard, "written", lambda df, name: (out := real(df, name), seen.append(out.count()) if name == "sets" else None)[0])
    got, want = linked(sets, jaccard.joined(set_table(spark, sets), 0.9), 90)
    assert got == want and len(set(want)) < len(sets)
    assert max(seen) <= 2 * len(sets)


def test_family_is_met_at_once(monkeypatch):
    """Many near copies of one text are told apart by few looks at all of them, not by one look for each."""
    rng = np.random.default_rng(9)
    some = rng.integers(0, 2 ** 64, 100, np.uint64)
    sets = [np.unique(np.concatenate([np.delete(some, rng.choice(100, 4, replace=False)), rng.integers(0, 2 ** 64, 3, np.uint64)])) for _ in range(300)]
    looks, real = [], jaccard.Region.shared
    monkeypatch.setattr(jaccard.Region, "shared", lambda self, one, others: looks.append(one) or real(self, one, others))
    for table in (jaccard.TABLE, 0):
        monkeypatch.setattr(jaccard, "TABLE", table)
        got = np.arange(300)
        for i, r in jaccard.region_links(np.arange(300), sets, 0.9):
            got[i] = r
        want = list(range(300))
        for a in range(300):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if want[a] != want[b] and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = want[a], want[b]
                    want = [min(x, y) if u in (x, y) else u for u in want]
        assert got.tolist() == want and 1 < len(set(want)) < 300
        assert not table or len(looks) < 30


# -- 9 ---------------------------------------------------------------------------------------------------------------

def test_segmentations(docs, empty):
    coded = segment.encode(docs).cache()
    rows = segment.decode(coded).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in rows) and {tuple(r["ids"]) for r in rows if r["doc_id"] == 1} and len({tuple(r["ids"]) for r in rows if r["doc_id"] == 1}) == 1
    assert segment.encode(empty).count() == 0
    v = segment.vocabulary(segment.MODEL, 1.0)
    odd = ["a  b\n▁x été\t😀日本語", "x" * 500 + " ok", "▁", " lead", "trail ", "\x00"]
    for t, o in zip(odd, segment.sampled(odd, list(range(6)), v), strict=True):
        assert segment.decoded(o.tolist(), v) == t
    alone = segment.sampled(odd[1:2], [1], v)[0]
    assert (alone == segment.sampled(odd, list(range(6)), v)[1]).all()


def test_sampling_follows_the_lattice():
    v = segment.vocabulary(segment.MODEL, 0.3)

    def paths(codes):
        if not codes:
            return [((), 1.0)]
        out = []
        for k in range(1, len(codes) + 1):
            i = v.by_text.get("".join(map(chr, codes[:k])))
            if i is not None:
                out += [((i, *rest), v.weight[i] * p) for rest, p in paths(codes[k:])]
        return out

    every = paths(segment.codes_of("then"))
    total, n = sum(p for _, p in every), 20_000
    got = Counter(tuple(x.tolist()) for x in segment.sampled(["then"] * n, np.random.default_rng(0).integers(0, 2 ** 63, n).tolist(), v))
    long = Counter(tuple(segment.alone(segment.codes_of("then"), v, k * 7919)) for k in range(4000))
    assert all(abs(got[a] / n - p / total) < 0.015 and abs(long[a] / 4000 - p / total) < 0.03 for a, p in every)


# -- 10 --------------------------------------------------------------------------------------------------------------

def test_scores(spark, docs, empty):
    assert lm.mixing_scores(empty).count() == 0
    rng = np.random.default_rng(6)
    a, b = [f"aa{i}" for i in range(40)], [f"bb{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(a if i % 2 else b, 40))) for i in range(300)] + [(300, None), (301, ""), (302, "NEW Words"), (7, "aa1"), (None, "aa2")]
    got = lm.mixing_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    mod = lambda d: zlib.crc32(("null" if d is None else str(d)).encode()) % 10
    counts = Counter()
    for i, t in rows:
        if mod(i):
            counts.update([*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    want = sorted((i if i is not None else -1, len((t or "").split()) + 1, sum(counts[w] > 0 for w in [*(t or "").encode().lower().split(), None]),
                   round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*(t or "").encode().lower().split(), None]), 6)) for i, t in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    held = [r for r in got if r["held_out"] and r["n_tokens"] > 5]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held) and all(r["score"] < 0 and r["train_tokens"] == n for r in got)
    assert lm.mixing_scores(docs).count() == docs.count()


def small_model(texts, vocabulary=None):
    """A model of texts, with tables counted in this process."""
    words = Counter(w for t in texts for w in t.encode().lower().split())
    ranked = sorted(words.items(), key=lambda x: (-x[1], x[0]))
    top, rest = ranked[:12], ranked[12:]
    letters = np.zeros(256)
    for w, c in rest:
        letters += np.bincount(np.frombuffer(w + b" ", np.uint8), minlength=256) * c
    marks = [w for w, _ in ranked[:10]]
    has = np.array([[w in t.encode().lower().split() for w in marks] for t in texts], float)
    m = lm.Model(top, sum(c for _, c in rest), len(texts), letters, vocabulary or len(ranked), marks, has.T @ has)
    t, tables = lm.Text(texts, lm.Lexicon(m)), lm.Tables(m.bits)
    n, at = m.code.steps(t.symbol)
    tables.add(m.slots(m.bases(t, m.classes(t)), np.arange(len(t.symbol)), n, at), m.code.bit[at])
    tables.settle()
    m.tables = [lm._whole(np.log((tables.n[1, a:b] + lm.PRIOR) / (tables.n[0, a:b] + lm.PRIOR))) for a, b in zip(tables.base[:-1], tables.base[1:])]
    spell, own = lm.Tables(lm.SPELL_BITS), [(w, c) for w, c in rest]
    word, _, at, slots, _ = m.spelled([w for w, _ in own], np.zeros(len(own), np.int64))
    spell.weighted(slots, m.letters.bit[at], np.array([c for _, c in own], float)[word])
    m.spell_tables = [lm._whole(np.log((spell.n[1, a:b] + lm.PRIOR) / (spell.n[0, a:b] + lm.PRIOR))) for a, b in zip(spell.base[:-1], spell.base[1:])]
    return m, own


@pytest.fixture(scope="module")
def letters_model():
    rng = np.random.default_rng(14)
    common = [f"c{i}" for i in range(15)]
    return small_model([" ".join([*rng.choice(common, 300), *(f"rare{rng.integers(0, 90)}" for _ in range(20))]) for _ in range(40)])


def test_probabilities_of_all_symbols_add_up_to_1(letters_model):
    """After any beginning, the mixed and refined probabilities of all words with a code, the escape and the end."""
    m, _ = letters_model
    for start in ("", "c1 c2", "c3 rare5 c1 unseen", " ".join(["c1 c4"] * 200)):
        end, n = 2.0 ** m.scores([start], lm.Lexicon(m))[0][0], len(start.split())
        # the next token's probability, as a naive reading of the bits gives it
        rest = [naive_bits(m, (start + " " + w.decode()).strip())[n] for w in [*m.symbol, b"other"]]
        assert end == pytest.approx(2.0 ** sum(naive_bits(m, start)), rel=1e-4)
        assert sum(2.0 ** x for x in rest) + 2.0 ** naive_bits(m, start)[-1] == pytest.approx(1, abs=1e-4)


def naive_bits(m, text):
    """log2 probability of each token's code, bit by bit in plain Python, with the same steps of weights and maps."""
    t = lm.Text([text], lm.Lexicon(m))
    s, bases = t.symbol, m.bases(t, m.classes(t))
    w, maps = m.mix.w.astype(float), m.mix.map.astype(float)
    out, seen = [], []
    for i in range(len(s)):
        if i and i % lm.STEP == 0:
            grad, count, moved, hits = np.zeros_like(w), Counter(), Counter(), Counter()
            for x, gate, err, spot, miss in seen:
                grad[:, gate] += err * np.array(x)
                count[gate] += 1
                moved[spot] += miss
                hits[spot] += 1
            for gate, n in count.items():
                w[:, gate] += lm.RATE / math.sqrt(n + 1) * grad[:, gate]
            for (gate, k), n in hits.items():
                maps[gate, k] = min(max(maps[gate, k] + lm.MAP_RATE * moved[gate, k] / math.sqrt(n), 1e-4), 1 - 1e-4)
            seen = []
        total = 0.0
        for step in range(int(m.code.length[s[i]])):
            at = int(m.code.start[s[i]]) + step
            bit = int(m.code.bit[at])
            x = [float(table[((int(b[i]) + int(m.code.node[at])) * int(lm._STIR) & 0xFFFFFFFF) >> (32 - bits)]) / lm.FINE for table, b, bits in zip(m.tables, bases, m.bits)]
            gate = min(step, lm.DEPTHS - 1) * lm.LEVELS + (x[1] != 0) + (x[3] != 0)
            x.append(1.0)
            z = min(max(sum(a * b for a, b in zip(x, w[:, gate])), -8), 8)
            p = 1 / (1 + math.exp(-z))
            f = (z + 8) * (lm.APM - 1) / 16
            low = min(int(f), lm.APM - 2)
            f -= low
            own = maps[gate, low] + (maps[gate, low + 1] - maps[gate, low]) * f
            seen.append((x, gate, bit - p, (gate, low + (f > 0.5)), bit - own))
            q = (own + p) / 2
            total += math.log2(q if bit else 1 - q)
        out.append(total)
    return out


def test_scores_are_those_of_a_naive_reading(letters_model):
    m, _ = letters_model
    for text in ("", "c1 c2 rare3", " ".join(f"c{i * i % 15} rare{i % 7}" for i in range(200))):
        assert m.scores(["c5 c6", text, "c1 " * 500], lm.Lexicon(m))[0][1] == pytest.approx(sum(naive_bits(m, text)), rel=1e-3)


def test_spellings_are_a_distribution(letters_model):
    """The probabilities of the letters that may follow a beginning add up to 1, also with words known and online steps."""
    m, own = letters_model
    train, n = [w for w, _ in own], np.array([c for _, c in own])
    plain = m.costs(train, np.zeros(len(train), np.int64), n, np.full(len(train), 2))
    assert (plain < 0).all() and sum(2.0 ** plain) < 1
    new = [b"zzqy", b"rare999"]
    both = m.costs([*train, *new], np.zeros(len(train) + 2, np.int64), np.append(n, [0, 0]), np.full(len(train) + 2, 2))
    assert both[:-2] == pytest.approx(plain, abs=1e-9) and both[-2] < both[-1] < 0
    for start in (b"", b"ra", b"rare1"):  # each next letter closes or goes on; words with the same beginning share its bits
        total = 0.0
        ones = [start + bytes([x]) for x in range(256) if x != 32] + [start]
        ones = [w for w in ones if w]
        word, place, at, slots, _ = m.spelled(ones, np.zeros(len(ones), np.int64))
        x = [lm._logits(table, k) for table, k in zip(m.spell_tables, slots)]
        z = np.clip(np.sum(x, axis=0) / 3, -8, 8)
        p = np.where(m.letters.bit[at] == 1, 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(z)))
        here = place == len(start)
        total = np.exp(np.bincount(word[here], np.log(p[here]), len(ones)))
        assert total.sum() == pytest.approx(1 if start else total.sum(), abs=1e-4)


def test_contexts_know_rare_words(letters_model):
    """Words without a code of their own are contexts of their own; codes grow with the vocabulary, tables up to a bound."""
    m, _ = letters_model
    bases = []
    for text in ("rare1 c1", "rare2 c1"):
        t = lm.Text([text], lm.Lexicon(m))
        bases.append([int(b[1]) for b in m.bases(t, m.classes(t) * 0)])
    assert bases[0][0] == bases[1][0] and all(a != b for a, b in zip(bases[0][1:], bases[1][1:], strict=True))
    assert lm.n_symbols(640_000) == 10_000 and lm.table_bits(10_000_000)[1] == lm.WORD_BITS[1] > lm.table_bits(1000)[1]


def test_classes_follow_what_occurs_together():
    meet = np.kron(np.eye(2), np.full((4, 4), 50.0)) + 1
    share = lm.classes_of(meet)
    likeliest = share[:, :8].argmax(0)
    assert len(set(likeliest[:4])) == 1 and len(set(likeliest[4:])) == 1 and likeliest[0] != likeliest[4] and lm.classes_of(np.zeros((0, 0))).shape == (8, 1)


def test_codes_are_of_all_training_documents(spark):
    df = spark.createDataFrame([(i, f"the word{i % 700} the") for i in range(1400)], "doc_id long, text string")
    top, escapes, ends, letters, size, marks, meet = lm.fitted_counts(df, [b"the", b"word1", b"none"])
    assert top[0] == (b"the", 2800) and len(top) == lm.SYMBOLS and escapes == 4200 - sum(c for _, c in top) and (ends, size) == (1400, 701)
    assert letters[32] == escapes and letters.sum() == sum(2 * (len(f"word{i}") + 1) for i in range(700) if f"word{i}".encode() not in dict(top))
    assert meet.tolist() == [[1400, 2, 0], [2, 2, 0], [0, 0, 0]]


def test_most_frequent(spark):
    """The same rows as a sort of all, with ties, few rows, and none."""
    rng = np.random.default_rng(15)
    rows = [(f"w{i:05d}", int(n)) for i, n in enumerate(np.minimum(rng.zipf(1.4, 4000), 5000))]
    df = spark.createDataFrame(rows, "word string, n long")
    for k in (1, 50, 700, 9000):
        got = [(r["word"], r["n"]) for r in lm.most_frequent(df, "n", ["word"], k).collect()]
        want = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
        assert [n for _, n in got] == [n for _, n in want] and [w for w, n in got if n > want[-1][1]] == [w for w, n in want if n > want[-1][1]]
    assert lm.most_frequent(df.limit(0), "n", ["word"], 5).count() == 0


def test_beginnings_that_many_share(spark, monkeypatch):
    """Words meet by a longer beginning where a short one is too common, and none is lost."""
    monkeypatch.setattr(lm, "SPELLED", 20)
    rows = [(f"http://site{i % 3}/{i}", 0) for i in range(600)] + [(f"w{i}x", 0) for i in range(100)]
    got = lm.together(spark.createDataFrame(rows, "word string, class int"), 700).collect()
    assert len(got) == 700 and {r["silent"] for r in got if r["word"].startswith("w")} == {3} and min(r["silent"] for r in got if r["word"].startswith("http")) > 10


# -- shared ----------------------------------------------------------------------------------------------------------

def test_attach(spark):
    rows = spark.createDataFrame([(i, "hot") for i in range(2000)] + [(i, f"k{i}") for i in range(2000, 2100)] + [(1, None), (2, "none")], "i long, k string")
    facts = spark.createDataFrame([("hot", 2000, "H"), ("k2001", 1, "C"), (None, 1, "N")], "k string, n long, v string")
    got = {(r["i"], r["k"]): r["v"] for r in common.attach(rows, facts, "k", "i", 2102).collect()}
    assert len(got) == 2102 and got[5, "hot"] == "H" and got[2001, "k2001"] == "C" and got[2002, "k2002"] is None and got[1, None] == "N" and got[2, "none"] is None


def test_indicators_are_of_all_documents(spark):
    """Words in an exact order of how many documents hold them: a sample of documents would not tell it."""
    words = [f"w{i:03d}" for i in range(lm.INDICATORS + 20)]
    held = [(d, " ".join(w for i, w in enumerate(words) if d < 3000 - 3 * i)) for d in range(3000)]
    got = lm.indicators_of(spark.createDataFrame(held, "doc_id long, text string"))
    assert got == [w.encode() for w in words[:lm.INDICATORS]]


def test_every_training_text_teaches_weights(spark):
    """Bits that moved the weights are all those of training texts' codes."""
    texts = [f"a b c{i % 7} d" for i in range(40)]
    docs = spark.createDataFrame([(i, x, i % 5 == 0) for i, x in enumerate(texts)], "doc_id string, text string, held_out boolean")
    m = lm.Model([(b"a", 40), (b"b", 40), (b"d", 40)], 40, 40, np.ones(256), 10, [], np.zeros((0, 0)))
    seen = lm.taught(lm.counted(docs, spark.sparkContext.broadcast(zlib.compress(pickle.dumps(m), 1))).filter("block < 0"))[2]
    n, _ = m.code.steps(np.array([0, 1, m.escape, 2, m.end]))
    assert seen == 32 * int(n.sum())


def test_contexts_are_made_once_a_token(spark, monkeypatch):
    """What a task learns from and what it counts are the same slots: they are made once, and lexicons tell words by what is known of them."""
    import pickle
    import zlib

    docs = spark.createDataFrame([(i, "a b c d zz " * 40, i % 10 == 0) for i in range(20)], "doc_id long, text string, held_out boolean")
    m = lm.Model([(b"a", 40), (b"b", 40), (b"d", 40)], 40, 40, np.ones(256), 10, [b"c"], np.ones((1, 1)))
    made, calls = lm.Model.slots, []
    monkeypatch.setattr(lm.Model, "slots", lambda self, bases, of, n, at: (calls.append(len(of)), made(self, bases, of, n, at))[1])

    class Plain:
        def select(self, *columns):
            return self

        def mapInPandas(self, run, schema):
            monkeypatch.setattr(lm.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
            return list(run([docs.select("text", "held_out").toPandas()]))

    class Sent:
        value = zlib.compress(pickle.dumps(m), 1)

    out = lm.counted(Plain(), Sent())
    assert sum(calls) == 18 * 201
    words = [(r.word, getattr(r, "n_train"), r.n_all) for o in out for r in o.itertuples() if r.word is not None]
    assert sorted({w for w, *_ in words}) == ["c", "zz"] and sum(n for w, n, _ in words if w == "zz") == 18 * 40 and sum(n for w, _, n in words if w == "zz") == 20 * 40
    lexicon = lm.Lexicon(m, {b"zz": 7, b"a": 3})
    for again in range(2):
        numbers = [lexicon[w] for w in (b"a", b"c", b"zz", b"new", b"new")] + [-1]
        symbol, sign, told, row = (x[numbers].tolist() for x in lexicon.settled())
        assert symbol == [0, 3, 3, 3, 3, 4] and sign == [1, 0, 1, 1, 1, 1] and row == [3, -1, 7, -1, -1, -1] and told[3] == told[4] != told[0] and lexicon.others() == 1
        lexicon.forget(1)
        assert lexicon.others() == 0 and len(lexicon.words) == len(lexicon)


def test_indicators_are_lower_cased_as_tokens_are(spark):
    """A-Z alone are lower-cased, as in what is counted later: an indicator that no token equals is none."""
    held = spark.createDataFrame([(i, "\u00c4B a\u0085b \u0130") for i in range(3)] + [(4, None)], "doc_id long, text string")
    assert lm.indicators_of(held) == sorted("\u00c4b a\u0085b \u0130".encode().split(b" "))


def test_words_are_counted_in_one_pass(spark):
    """Words of odd texts, how often they occur and how many texts hold them, as plain Python has them; indicators come of these
    counts without another look at the texts, and co-occurrence is that of whole words."""
    odd = ["a  B\n\x0bc\td ", " \x0c\r", "", None, "Äb a\u0085b İ a\x1cb", "a a a", "x\x00y A", "w" * 70_000] + [f"k{i % 9} a k{i % 4}" for i in range(1200)]
    split = [(t or "").encode().lower().split() for t in odd]
    n, words = lm.tokens(odd)
    assert n.tolist() == list(map(len, split)) and words.to_pylist() == [w for s in split for w in s]
    assert lm.tokens([])[0].tolist() == [] and lm.tokens(["\ud800 a"])[1].to_pylist() == ["\ud800".encode("utf-8", "surrogatepass"), b"a"]
    docs = spark.createDataFrame([(t,) for t in odd], "text string")
    got = lm.words_of(docs.repartition(3)).collect()
    often, held = Counter(w for s in split for w in s), Counter(w for s in split for w in set(s))
    assert sorted((bytes(r["word"]), r["n"], r["held"]) for r in got) == sorted((w, k, held[w]) for w, k in often.items())
    marks = lm.indicators_of(None, spark.createDataFrame(got))
    assert marks == sorted(held, key=lambda w: (-held[w], w))[:lm.INDICATORS] == lm.indicators_of(docs)
    some = [b"a", b"k1", b"b"]
    assert lm.meetings(docs, some).tolist() == [[sum(x in s and y in s for s in split) for y in some] for x in some]
