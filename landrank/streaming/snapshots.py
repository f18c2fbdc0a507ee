"""Change events from snapshots as they land: the prior snapshot is keyed state, in buckets of each partition."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = T.StructType([T.StructField(c, T.StringType()) for c in ("run_id", "partition", "key", "kind", "field", "before", "after")])


class Changes(StatefulProcessor):
    """For a bucket of a partition: what each row of a run changes against the rows held, and what a run that is complete lacks."""

    def __init__(self, fields: list[str]):
        self.fields = fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getMapState("held", T.StructType([T.StructField("key", T.StringType())]),
                                       T.StructType([T.StructField("content", T.ArrayType(T.StringType())), T.StructField("stale", T.BooleanType()), T.StructField("run", T.StringType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        partition = key[0]
        # a run's rows before its end; runs in their order
        for run, ends, record, content in sorted(((r["run_id"], r["complete"], r["key"], r["content"]) for r in rows), key=lambda x: (x[0], x[1], x[2] or "")):
            event = lambda record, kind, field=None, before=None, after=None: Row(run_id=run, partition=partition, key=record, kind=kind, field=field, before=before, after=after)  # noqa: B023, E731
            if ends:
                for (other,), (old, stale, seen) in [(tuple(k), tuple(v)) for k, v in self.held.iterator()]:
                    if seen != run and not stale:
                        self.held.updateValue((other,), (old, True, seen))
                        yield event(other, "stale")
                continue
            if not self.held.containsKey((record,)):
                yield event(record, "new")
            else:
                old, stale, _ = tuple(self.held.getValue((record,)))
                diffs = [(f, a, b) for f, a, b in zip(self.fields, old, content, strict=True) if a != b]
                if not diffs and stale:
                    yield event(record, "returned")
                for f, a, b in diffs:
                    yield event(record, "changed", f, a, b)
            self.held.updateValue((record,), (list(content), False, run))

    def close(self) -> None:
        pass


def snapshot_events(rows: DataFrame, ends: DataFrame, key: str, partition: str, fields: list[str], buckets: int = 16) -> DataFrame:
    """Streams of rows (run_id, key, partition, fields) and of runs' ends (run_id, partition) to change events (EVENT).

    Runs are ordered by id; a run's rows must land no later than its end, and a partition's end only if it is complete,
    as rows that it lacks go stale then.  A partition is held in so many buckets by key, each told of its ends, so a county
    with most of the rows is no single task's; a bucket's rows of a batch are sorted in memory.  A null key is no row.
    State and events survive a restart from the same checkpoint.
    """
    spark = rows.sparkSession
    if "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    own = rows.filter(F.col(key).isNotNull()).select(F.col(partition).cast("string").alias("partition"), F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int").alias("bucket"), "run_id",
                                                     F.lit(False).alias("complete"), F.col(key).cast("string").alias("key"), F.array(*[F.col(f).cast("string") for f in fields]).alias("content"))
    done = ends.select(F.col(partition).cast("string").alias("partition"), F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "run_id", F.lit(True).alias("complete"),
                       F.lit(None).cast("string").alias("key"), F.lit(None).cast("array<string>").alias("content"))
    return own.unionByName(done).groupBy("partition", "bucket").transformWithState(Changes(fields), EVENT, "Append", "None")
