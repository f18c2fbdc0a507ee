"""Change events of a stream of snapshots, restarted between batches, against those of whole snapshots."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from landrank.operators import delta
from landrank.streaming.snapshots import snapshot_events

ROW = "run_id string, record_id string, fips string, value double, acreage double"
FIELDS = ["value", "acreage"]


def test_stream_equals_snapshots(spark, tmp_path):
    """Four runs, the stream stopped after each: new, changed, stale and returned rows, counties that are not complete."""
    rng = random.Random(11)
    (tmp_path / "rows").mkdir()
    (tmp_path / "ends").mkdir()
    rows = lambda: spark.readStream.schema(ROW).json(f"file://{tmp_path}/rows")
    ends = lambda: spark.readStream.schema("run_id string, fips string").json(f"file://{tmp_path}/ends")
    prior, want = None, set()
    for n in range(4):
        run = f"2024-01-0{n + 1}"
        staged = [(f"r{i}", str(i % 3), rng.choice([1.0, 2.5, None]), float(i % 2)) for i in range(60) if rng.random() < 0.7]
        complete = ["0", "1"] if n % 2 else ["0", "1", "2"]
        (tmp_path / "rows" / f"{run}.json").write_text("\n".join(json.dumps(dict(zip(("run_id", "record_id", "fips", "value", "acreage"), (run, *r), strict=True))) for r in staged))
        (tmp_path / "ends" / f"{run}.json").write_text("\n".join(json.dumps({"run_id": run, "fips": c}) for c in complete))
        query = snapshot_events(rows(), ends(), "record_id", "fips", FIELDS, buckets=4).writeStream.format("json").option("path", f"file://{tmp_path}/events").option(
            "checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        s = spark.createDataFrame(staged, "record_id string, fips string, value double, acreage double")
        done = spark.createDataFrame([(c,) for c in complete], "fips string")
        before = prior if prior is not None else s.limit(0).withColumns({c: F.lit(None).cast("string") for c in ("status", "first_seen", "last_seen")})
        want |= {(run, r["fips"], *[r[c] for c in ("record_id", "kind", "field", "before", "after")]) for r in delta.change_events(s, before, "record_id", "fips", FIELDS, done).collect()}
        after = delta.carried_forward(s, before, "record_id", "fips", done, F.lit(run))
        prior = spark.createDataFrame(after.collect(), after.schema)
    got = [tuple(r[c] for c in ("run_id", "partition", "key", "kind", "field", "before", "after")) for r in spark.read.schema(
        "run_id string, partition string, key string, kind string, field string, before string, after string").json(f"file://{tmp_path}/events").collect()]
    assert len(got) == len(set(got)) and set(got) == want and {x[3] for x in want} == {"new", "changed", "stale", "returned"}
