"""Merges that leave untouched buckets alone, and gates that are measured while rows are written."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from landrank.operators.delta import upserted
from landrank.operators.quality import GateError
from landrank.sources import buckets

def gates():
    return {"rows": (F.count(F.lit(1)), lambda n: n > 0), "least": (F.min("v"), lambda x: x >= 0)}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def table(spark, n=5000):
    return spark.range(n).select((F.col("id") % 100).alias("county"), "id", (F.col("id") / 7).alias("v"), F.lit(1).alias("seq"))


def test_one_in_a_hundred_keys(spark, tmp_path):
    """A county's rows change, some are new: one bucket is written, all other files stay; the table is that of upserted()."""
    path, base = f"file://{tmp_path}/t", table(spark)
    first = buckets.merge(base, path, "v1", ["county", "id"], "seq", by=["county"], buckets=32)
    before = files(tmp_path)
    new = base.filter("county = 42").withColumns({"v": F.col("v") + 1, "seq": F.lit(2)}).unionByName(spark.createDataFrame([(42, 90000, 0.5, 1)], "county long, id long, v double, seq int"))
    got = buckets.merge(new, path, "v2", ["county", "id"], "seq")
    after = files(tmp_path)
    assert len(got["rewritten"]) == 1 and len(got["kept"]) == len(first["rewritten"]) - 1 > 20
    assert all(after[f] == t for f, t in before.items()) and len(after) - len(before) <= 2
    assert rows(buckets.read(spark, path)) == rows(upserted(base, new, ["county", "id"], "seq"))
    now = buckets.state(spark, path)
    assert now["version"] == "v2" and now["by"] == ["county"] and now["buckets"] == 32 and buckets.read(spark, path).schema["id"].dataType == base.schema["id"].dataType
    assert buckets.merge(new.limit(0), path, "v3", ["county", "id"], "seq")["rewritten"] == [] and buckets.state(spark, path)["version"] == "v2"


def test_gates_stop_the_swap(spark, tmp_path):
    path, base = f"file://{tmp_path}/t", table(spark, 300)
    good = buckets.merge(base, path, "v1", ["id"], "seq", buckets=4, gates=gates())
    assert good["values"] == {"rows": 300, "least": 0.0}
    before, want = files(tmp_path), rows(buckets.read(spark, path))
    with pytest.raises(GateError, match="least = -5"):
        buckets.merge(base.withColumns({"v": F.lit(-5.0), "seq": F.lit(2)}), path, "v2", ["id"], "seq", gates=gates())
    with pytest.raises(Exception, match="broken"):
        buckets.merge(base.withColumn("v", F.when(F.col("id") < 299, 1.0).otherwise(F.raise_error(F.lit("broken")).cast("double"))), path, "v2", ["id"], "seq", gates=gates())
    assert files(tmp_path) == before and rows(buckets.read(spark, path)) == want and buckets.state(spark, path)["version"] == "v1"


def test_gates_cost_no_second_pass(spark, tmp_path):
    """The rows behind a gate are computed once, as a counter in them shows."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = table(spark, 500).mapInPandas(counted, "county long, id long, v double, seq int")
    values = buckets.watched(df, gates(), lambda d: d.write.parquet(f"file://{tmp_path}/w"))
    assert values["rows"] == 500 and seen.value == 500


def test_merge_on_edges(spark, tmp_path):
    """Null keys are a key, ties of the order go to the new row, columns keep their types, a first version can be small."""
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([(None, 1, "a"), (1, 1, "b"), (2, None, None)], "k int, o int, `odd name` string")
    buckets.merge(df, path, "v1", ["k"], "o")
    buckets.merge(spark.createDataFrame([(None, 1, "new"), (2, 5, "x")], "k int, o int, `odd name` string"), path, "v2", ["k"], "o")
    assert rows(buckets.read(spark, path)) == sorted([(None, 1, "new"), (1, 1, "b"), (2, 5, "x")], key=repr)
