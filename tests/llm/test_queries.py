"""The registered queries against their SQL, and the pipeline against brute force on its own stages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from landrank.llm import pii, queries
from tests.oracle import SF, answer, assert_same

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    assert_same(queries.QUERIES[name](spark, SF).toPandas(), answer(queries.SQL[name]))


def test_names():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, len(queries.QUERIES) + 1)]


def test_pipeline(spark):
    docs = queries.table(spark, SMALL, "documents")
    start, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, SMALL), name)
        left = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert left <= ids
        ids = left
        if name == "near_copies":
            texts = {r["doc_id"]: r["text"].encode().lower().split() for r in before.collect()}
            sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} for i, w in texts.items()}
            kept = sorted(left)
            assert not any(sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for n, a in enumerate(kept) for b in kept[:n])
        if name == "personal_data":
            assert docs.count() == before.count()
            found = lambda d: {x for r in d.select(F.explode(F.regexp_extract_all("text", F.lit(pii.ANY), F.lit(0))).alias("x")).collect() for x in [r["x"]]}
            assert found(before) and not found(before) & found(docs)
        if name != "sentencepiece":
            assert docs.columns == start
    assert docs.filter("n_pieces > 0").count() > 0


EDGES = "doc_id long, text string, lang string, source string, n_chars long, copies int, nth int, made int, row int, hash int, id int, size int, score double, threshold string, Rejected string, entities string"


def test_stages_on_edges(spark):
    """Every stage on nulls in each column, empty and very long texts, repeats, clashing names, and no rows at all."""
    x = (1, 2, 3, 4, 5, 6, 7, 0.5, "t", "r", "e")
    text = "one two three four five six seven eight"
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, text, "en", "a", 5, *x), (1, text, "en", "a", 5, *x), (1, "a text of its own for this one id here", "en", "a", 5, *x), (2, None, None, None, None, *x), (3, "", "en", "a", 0, *x),
            (None, text, None, None, 1, *x), (None, text, None, None, 1, *x), (4, long, "en", "b", 1, *x), (5, text, "en", "b", 5, *x), (6, " \n\t ", "en", "b", 3, *x), (7, "Mr John Doe and a@b.org", "en", "b", 3, *x)]
    docs = spark.createDataFrame(rows, EDGES)
    texts = lambda d: sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in d.collect())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        out = stage(spark, docs, SMALL)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        if name == "near_copies":
            want = sorted((r[0] if r[0] is not None else -1, r[1] or "") for k, r in enumerate(rows) if k not in (1, 8))
            assert texts(out) == want
        if name == "personal_data":
            kept = {r["doc_id"]: r for r in out.collect()}
            assert out.count() == len(rows) and kept[2]["text"] is None and kept[2]["n_chars"] is None and kept[3]["text"] == "" and "Doe" not in kept[7]["text"] and kept[4]["text"] == long
            assert all(tuple(r[c] for c in docs.columns[5:]) == x for r in kept.values())
        if name == "mixing":
            got = texts(out)
            assert set(got) <= set(texts(docs)) and not any(t.split() == [] for _, t in got)
        if name == "sentencepiece":
            assert out.count() == len(rows) and {r["n_pieces"] for r in out.filter("doc_id in (2, 3)").collect()} == {0}
