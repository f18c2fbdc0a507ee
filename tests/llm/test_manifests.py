"""License scans, conversation tries and dataset manifests, on small rows and against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest

from landrank.llm import licenses, manifest, tries

DOC = "doc_id long, text string, lang string, source string, n_chars long, digest string, labels string, t string, score string"
CLASH = ("d", "l", "t", "s")


# -- 11 --------------------------------------------------------------------------------------------------------------

def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_base(text):
    w = plain_words(text)
    hits = [(i, label) for label, phrase in licenses.PHRASES for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in hits]
    return len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in hits}))


def scanned(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r for r in licenses.license_scan(df, **options).collect()}


def test_base_phrases_by_brute_force(spark):
    rng = random.Random(3)
    pool = ["under", "The", "MIT", "license", "apache", "License,", "version", "2.0", "cc", "by-nc", "BY", "nc", "x\u00e9", "\u212a", "a1"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 2, 3, 5, 40, 400]))) for _ in range(60)]
    texts += ["Under the MIT License", "under the mit license " * 500, "CC-BY-NC", "CC BY", "apache license version 20", "(cc)by\tnc\ncc by nc", None, ""]
    got = scanned(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_base(t)
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1


def test_notices_with_changed_words(spark):
    """A notice is found with words changed, left out and put in; not one that tells another license, nor scattered words."""
    mit = next(text for label, least, text in licenses.NOTICES if label == "mit" and least < 1).split()
    rng = random.Random(4)
    filler = ["lorem", "ipsum", "dolor"] * 40
    changed = list(mit)
    for i in (7, 30, 51):
        changed[i] = "other"
    shifted = mit[:20] + ["new", "words"] + mit[20:45] + mit[48:]
    half, mixed = mit[:len(mit) // 2], rng.sample(mit, len(mit))
    texts = [" ".join(filler + x + filler) for x in (mit, changed, shifted, half, mixed)] + ["GNU General Public License, version 2", "licensed under CC BY-SA 4.0", " ".join((mit + filler) * 30)]
    got = scanned(spark, texts)
    assert [got[i]["labels"] for i in range(8)] == ["mit", "mit", "mit", "", "", "gpl-2", "cc-by-sa", "mit"]
    assert got[0]["score"] == 1 and 0.8 <= got[1]["score"] < 1 and 0.8 <= got[2]["score"] < 1 and 0.4 < got[3]["score"] < 0.8 and got[4]["score"] < 0.4
    assert [(s["label"], s["start"], s["end"]) for s in got[0]["spans"]] == [("mit", 120, 120 + len(mit))] and got[2]["spans"][0]["end"] - got[2]["spans"][0]["start"] == len(shifted)
    assert sorted(s["start"] for s in got[7]["spans"]) == [k * (len(mit) + 120) for k in range(30)]


def test_scan_on_edges(spark):
    text = "Under the MIT license and so on"
    long = "word " * 40_000 + "cc by nc"
    rows = [(1, text, "en", "a", 5, *CLASH), (1, text, "en", "a", 5, *CLASH), (1, "another", "en", "a", 5, *CLASH), (2, None, None, None, None, *CLASH), (3, "", None, None, 0, *CLASH),
            (None, text, None, None, 1, *CLASH), (None, text, None, None, 1, *CLASH), (4, long, None, None, 1, *CLASH), (5, "cc", None, None, 1, *CLASH), (6, " .,\n", None, None, 1, *CLASH)]
    docs = spark.createDataFrame(rows, DOC)
    out = licenses.license_scan(docs).collect()
    assert len(out) == len(rows)
    want = sorted(repr((r[0], *plain_base(r[1]))) for r in rows)
    assert sorted(repr((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])) for r in out) == want
    none = licenses.license_scan(docs.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    with pytest.raises(ValueError, match="3 words"):
        licenses.license_scan(docs, notices=(("x", 1.0, "two words"),))


def test_scan_of_a_hot_text(spark):
    """A third of all rows repeat one text: each gets its result."""
    from pyspark.sql import functions as F

    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, "Released under the MIT License.").otherwise(
        F.concat(F.lit("text "), F.col("id"))).alias("text"))
    out = licenses.license_scan(df)
    assert out.count() == 3000 and out.filter("doc_id is null and labels = 'mit' and n_base = 1 and first_word = 1 and n_words = 5").count() == 1000 and out.filter("labels <> ''").count() == 1000


# -- 12 --------------------------------------------------------------------------------------------------------------

def plain_trie(rows):
    """Nodes of the trie of (conv_id, turn, role, text), by comparing prefixes."""
    held = {}
    for c, turn, role, text in rows:
        if c is not None:
            held.setdefault(c, []).append((turn is not None, turn or 0, tries_code(role, text), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in held.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
    members = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids = {p: sum(len(x) == len(p) + 1 and x[:len(p)] == p for x in members) for p in members}
    out = []
    for p, cs in members.items():
        under = [x for x in members if x[:len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], sum(not kids[x] for x in under),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def tries_code(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(str(len(role)).encode() + b":" + role + text).digest()[:16]


CONV = "conv_id long, turn long, role string, text string"


def nodes(df):
    return sorted((tuple(r[c] for c in tries.NODE) for r in df.collect()), key=repr)


@pytest.mark.parametrize("held", [10 ** 6, 60, 12])
def test_trie_by_brute_force(spark, held):
    """One task, several, and several levels of contracted forests give the same trie."""
    rng = random.Random(held)
    rows = [(c, t, rng.choice(["user", "assistant"][:1 + (t > 2)]), rng.choice(["a", "bé", "c c"][:1 + (rng.random() < 0.4) + (t > 3)])) for c in range(-12, 150) for t in range(rng.choice([1, 2, 4, 7, 12]))]
    rows += [(c, t, "user", "same") for c in range(1000, 1040) for t in range(3)] + [(c, t, "user", "a") for c in range(2000, 2020) for t in range(c - 1995)]
    got = tries.prefix_trie(spark.createDataFrame(rows, CONV), held)
    assert nodes(got) == plain_trie(rows)


def test_trie_of_long_conversations(spark):
    rows = [(c, t, "user", f"t{t}" if t < 150 or c % 2 else f"u{t + c % 3}") for c in range(40) for t in range(300 if c % 7 else 155)]
    assert nodes(tries.prefix_trie(spark.createDataFrame(rows, CONV), 700)) == plain_trie(rows)


def test_trie_on_edges(spark):
    """Nulls in all columns, ties, repeated rows, conversations left without a turn, extra columns, no rows."""
    free = [c for c in range(3000, 3400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:4]
    rows = [(7, None, None, None), (7, 0, "user", None), (7, 0, "user", "x"), (7, 0, "user", "x"), (None, 0, "user", "lost"), (None, None, None, None), (8, 1, "", "long " * 50_000), (-3, 2, "user", "neg")]
    rows += [(c, 0, "user", "dropped") for c in free]
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], CONV + ", n int, codes string, depth int")
    got = nodes(tries.prefix_trie(df))
    assert got == plain_trie(rows) and next(r for r in got if r[1] == 0)[3] == len({r[0] for r in rows} - {None})
    assert tries.prefix_trie(df.limit(0)).collect() == []


def test_ends_of_very_many(spark, monkeypatch):
    """Ids of one hot sequence are joined in order across tasks and chunks."""
    monkeypatch.setattr(tries, "CHUNK", 64)
    from pyspark.sql import functions as F

    rows = spark.range(-500, 2500).select(F.unhex(F.when(F.col("id") % 3 == 0, "00").otherwise(F.lpad(F.hex(F.col("id") % 7), 4, "0"))).alias("s"), F.col("id").alias("conv_id")).repartition(5)
    want = {}
    for r in rows.collect():
        want.setdefault(bytes(r["s"]), []).append(r["conv_id"])
    got = {bytes(r["s"]): r["ends"] for r in tries.joined_hashes(rows).collect()}
    assert got == {s: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for s, v in want.items()}


# -- 13 --------------------------------------------------------------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def climbs(hashes):
    """The root of the hashes, and for each one its siblings as (left, right) on the way up."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i - i % 3:i - i % 3 + 3]
            paths[k].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        level, at = [digest("".join(level[i:i + 3])) for i in range(0, len(level), 3)], [i // 3 for i in at]
    return level[0], paths


def plain_manifest(rows):
    by = {}
    for r in rows:
        broken = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), plain_leaf((*r[:4], r[4].replace("\n", ""))) if broken else plain_leaf(r), r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(by[s]), *climbs([x[2] for x in sorted(by[s])])) for s in names}
    root, tops = climbs([trees[s][1] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        leaves, subroot, paths = trees[s]
        for (*_, leaf, hurt, doc), path in zip(leaves, paths, strict=True):
            for left, right in path + top:
                hurt = digest(left + hurt + right)
            out.append((doc, leaf, subroot, root, digest("".join(a + b for a, b in path + top)), hurt, hurt == root))
    return sorted(out, key=repr)


FILED = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def filed(df):
    return sorted((tuple(r[c] for c in FILED) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sizes", [[1], [3], [244], [2, 0, 1, 730, 9], [1] * 250, [2300, 1, 1]])
def test_manifest_by_brute_force(spark, sizes):
    """Trees and forests of one station and of several, with lone leaves and incomplete runs."""
    rows = [(1000 * s + i, f"s{s:03d}", "en", i, f"line {i}\nline" if i % 3 else f"line {i}") for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert filed(manifest.manifest(df)) == plain_manifest(rows)


def test_manifest_of_three_stations(spark, monkeypatch):
    """Stored rows that span one level: many stations, each copied for the leaves below."""
    for name, value in (("STRIDE", 1), ("SPAN", 3)):
        monkeypatch.setattr(manifest, name, value)
    rows = [(i, "b" if i < 100 else f"c{i}", "en", i, f"a\n{i}") for i in range(112)]
    assert filed(manifest.manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))) == plain_manifest(rows)


def test_manifest_on_edges(spark):
    """Nulls in all columns, repeated ids and rows, empty and very long texts, clashing names, no rows; settings stay."""
    rows = [(1, "a", "en", 1, "x\ny"), (1, "a", "en", 1, "x\ny"), (1, "a", "en", 1, "z\n"), (2, None, None, None, None), (None, "é", "en", 2, "t\n"), (None, "é", "en", 2, "t\n"), (None, None, None, None, None),
            (3, "", "en", 0, ""), (4, "z", "en", 5, "long\n" * 60_000), (-5, "Z", "en", 5, "\n"), (6, "a", "", 5, "é\n")]
    df = spark.createDataFrame([(*r, 7, "i", "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree int, hash string, leaf string, n int")
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    assert filed(manifest.manifest(df)) == plain_manifest(rows)
    none = manifest.manifest(df.limit(0))
    assert none.count() == 0 and none.columns == FILED and spark.conf.get("spark.sql.cteRecursionRowLimit", None) == before


def test_manifest_of_equal_rows(spark):
    """A third of all rows are equal, and one source holds most."""
    rows = [(5, "hot", "en", 1, "same\n")] * 400 + [(i, "hot", "en", 1, f"t{i}") for i in range(10, 700)] + [(i, f"s{i % 7}", "en", 1, f"u{i}\n") for i in range(1000, 1110)]
    assert filed(manifest.manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4))) == plain_manifest(rows)
