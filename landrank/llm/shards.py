"""Sharding by a two-pass external shuffle, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landrank.llm.common import scratch, starts

SEED = 6
#: Bytes of text and rows in a bucket, about: what one task holds at a time.
BUCKET_BYTES, BUCKET_ROWS = 8 << 20, 4096
#: Equal rows from this many on are dealt over buckets one by one; their keys are broadcast up to MOST_KEYS.
REPEATS, MOST_KEYS = 512, 100_000
#: How a row is written to be told from others: times to the microsecond, as they are held, and nulls.
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def text_size(column: str = "text"):
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + 1


def dealt(rows: DataFrame, n_keys: int, keys: DataFrame) -> DataFrame:
    """rows (key, row) with a number i of each among equal rows: 0, but for rows of keys (key, n) 0 to n - 1.

    Equal rows may stand for each other, so those of the given keys are put together, one to a key, and spread again by
    their count: the numbers are the same however rows lie in partitions, and no task holds the rows of a key.
    """
    if not n_keys:
        return rows.withColumn("i", F.lit(0).cast("long"))
    side = F.broadcast(keys) if n_keys <= MOST_KEYS else keys
    single = rows.join(side.select("key"), "key", "left_anti").withColumn("i", F.lit(0).cast("long"))
    one = rows.join(side, "key").groupBy("key").agg(F.first("row").alias("row"), F.first("n").alias("n"))
    runs = one.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / REPEATS)))).repartition("key", "run")
    each = runs.withColumn("i", F.explode(F.sequence(F.col("run") * REPEATS, F.least(F.col("n"), (F.col("run") + 1) * REPEATS) - 1)))
    return single.select("key", "row", "i").unionByName(each.select("key", "row", "i"))


def fisher_yates(n: Column, bucket: Column, seed: int) -> Column:
    """A permutation of 1 to n as an array, by swaps that depend on seed and bucket alone.

    The shuffle is done inside out: the i-th number takes a drawn place among the i first ones, and what was there goes
    to the end.
    """
    def swap(a: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(F.lit(seed), bucket, i), i).cast("int")  # a place before or its own
        moved = F.concat(F.slice(a, F.lit(1), j), F.array(i), F.slice(a, j + 2, F.greatest(F.lit(0), i - j - 2)), F.slice(a, j + 1, F.lit(1)))
        return F.when(j == i - 1, F.concat(a, F.array(i))).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), n), F.expr("cast(array() as array<int>)"), swap)


def external_shuffle(docs: DataFrame, shards: int, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs in a random order over all rows, as columns shard (0 to shards - 1) and slot (gapless from 0 in a shard).

    The first pass scatters rows uniformly over buckets of about bucket_bytes and bucket_rows by a seeded hash of the
    whole row, so that neither a source nor a group of copies meets in one; rows that are equal in all columns are dealt
    one by one (see dealt()).  The second puts each bucket into a canonical order and shuffles it by Fisher and Yates.
    Buckets follow each other; the row numbers so given are cut into runs whose lengths differ by one at most.  The order
    depends on seed and rows alone, not on partitions.  Null or empty texts weigh one byte; no rows give no rows; columns
    of any type and name are carried along, but shard and slot are replaced.
    """
    cols = [c for c in docs.columns if c not in ("shard", "slot")]
    total = docs.select(F.count(F.lit(1)).alias("n"), F.sum(text_size()).alias("bytes")).first()
    rows, buckets = total["n"], max(1, -(-(total["bytes"] or 0) // bucket_bytes), -(-total["n"] // bucket_rows))
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    keyed = docs.select(F.md5(F.to_json(row, EXACT)).alias("key"), row.alias("row"))
    repeated = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= REPEATS)
    by = dealt(keyed, repeated.count(), repeated)
    by = by.withColumn("b", F.pmod(F.xxhash64(F.lit(seed), "key", "i"), F.lit(buckets)).cast("int"))
    first = starts(by.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "b", "n", "start").withColumnRenamed("b", "first_b")
    # keys alone are sorted, as rows may hold what has no order; equal keys have equal rows
    held = by.groupBy("b").agg(F.collect_list(F.struct("key", "i", "row")).alias("rows"))
    held = held.withColumn("rows", F.array_sort("rows", lambda x, y: F.when(x["key"] < y["key"], -1).when(x["key"] > y["key"], 1).otherwise(0)))
    held = held.withColumn("order", fisher_yates(F.size("rows"), F.col("b"), seed)).join(first, F.col("b") == F.col("first_b"))
    out = held.select("start", F.posexplode(F.transform("order", lambda k: F.element_at("rows", k)["row"])).alias("at", "row"))
    out = out.withColumn("i", F.col("start") + F.col("at")).withColumn("shard", F.expr(f"cast(i * {shards} div {max(1, rows)} as int)"))
    slot = F.col("i") - F.expr(f"(shard * {rows}L + {shards} - 1) div {shards}")
    return out.select(*[F.col("row").getField(c).alias(c) for c in cols], "shard", slot.alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, **options) -> None:
    """external_shuffle(), written as Parquet with a folder for each shard; files hold rows in the order of slots."""
    _write(external_shuffle(docs, shards, **options), path)


def _write(out: DataFrame, path: str) -> None:
    out.write.partitionBy("shard").parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sharded(docs: DataFrame, shards: int = 16, **options) -> DataFrame:
    """Writes shards to the shared folder and reads them back."""
    path, out = scratch(docs.sparkSession, "shards"), external_shuffle(docs, shards, **options)
    _write(out, path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)
