"""Tables kept in buckets of keys behind a pointer: a merge writes only buckets that changed keys touch, gates watch the write."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landrank.operators.delta import upserted
from landrank.operators.quality import GateError
from landrank.sources.writers import _fs, read_pointer, swap_pointer

#: A gate: what is measured while rows are written (an aggregate, no distinct one), and whether the value passes.
Gate = tuple[Column, Callable[[object], bool]]


def watched(df: DataFrame, gates: dict[str, Gate], write: Callable[[DataFrame], None]) -> dict[str, object]:
    """Writes df and measures all gates in the same pass; returns the values, or raises with the names of those that fail.

    Nothing is read twice.  What was written when a gate fails is for the caller to take away.
    """
    if not gates:
        write(df)
        return {}
    seen = Observation()
    write(df.observe(seen, *[measure.alias(name) for name, (measure, _) in gates.items()]))
    values = seen.get
    if failed := [f"{name} = {values[name]}" for name, (_, passes) in gates.items() if not passes(values[name])]:
        raise GateError("; ".join(failed))
    return values


def bucket_of(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def _put(spark: SparkSession, path: str, value: dict) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    out.close()


def state(spark: SparkSession, path: str) -> dict | None:
    """What the pointer points to: version, buckets, by, schema, and the folder of each bucket; None if there is no pointer."""
    fs, p = _fs(spark, f"{path}/pointer.json")
    return json.loads(spark.read.text(read_pointer(spark, path)["current"], wholetext=True).first()[0]) if fs.exists(p) else None


def read(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """The table, or some of its buckets."""
    now = state(spark, path)
    folders = [f for b, f in now["folders"].items() if only is None or int(b) in only]
    return spark.read.schema(now["schema"]).parquet(*folders) if folders else spark.createDataFrame([], now["schema"])


def merge(df: DataFrame, path: str, version: str, key: list[str], order: str, by: list[str] | None = None, buckets: int = 64, gates: dict[str, Gate] | None = None) -> dict:
    """Upserts df's rows (one a key, the greatest `order` wins) into the table and swaps its pointer; {rewritten, kept, values}.

    Rows lie in buckets by a hash of `by`, columns of the key: rows that change together, as those of a county do, should
    share them.  Only touched buckets are read and written again, aside; files of the others stay as they are and are named by
    the new version's list.  A gate that fails, or a job that does, leaves the pointer where it was, and what was written goes.
    Buckets and `by` are the table's own from its first version on.  No rows change nothing.
    """
    spark = df.sparkSession
    old = state(spark, path)
    by, buckets = (old["by"], old["buckets"]) if old else (by or key, buckets)
    own = bucket_of(by, buckets)
    touched = sorted(r[0] for r in df.select(own.alias("b")).distinct().collect())  # no more than there are buckets
    if not touched:
        return {"rewritten": [], "kept": sorted(map(int, old["folders"])) if old else [], "values": {}}
    base = read(spark, path, touched) if old else df.limit(0)
    merged = upserted(base, df.select(*base.columns), key, order)
    folder = f"{path}/files/{version}-{uuid.uuid4().hex[:12]}"
    try:
        values = watched(merged, gates or {}, lambda m: m.withColumn("__bucket", own).repartition("__bucket").write.partitionBy("__bucket").parquet(folder))
    except Exception:
        fs, p = _fs(spark, folder)
        fs.delete(p, True)
        raise
    folders = (old["folders"] if old else {}) | {str(b): f"{folder}/__bucket={b}" for b in touched}
    listed = f"{path}/lists-{version}-{uuid.uuid4().hex[:12]}.json"
    _put(spark, listed, {"version": version, "buckets": buckets, "by": by, "schema": old["schema"] if old else ddl(df), "folders": folders})
    swap_pointer(spark, path, listed, version)
    return {"rewritten": touched, "kept": sorted(int(b) for b in folders if int(b) not in touched), "values": values}


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
