"""What the operators of this subpackage share: scratch tables, skew-proof look-ups, text columns."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: A key is hot if it holds more than one in HOT_SHARE of all rows, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Where it is unset, a session with a local master gets one of its own; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to a table in the shared folder and read again: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a table made by written()."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        removed(df.sparkSession, folder)


def removed(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freed(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most so many rows in an Arrow batch, as texts can be long; a smaller setting stays."""
    held = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < held <= rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def starts(counts: DataFrame, key: str, n: str, start: str, group: int = 4096) -> DataFrame:
    """counts (key from 0, n) with the sum of n over all smaller keys.

    Sums of runs of `group` keys come first, so that no task sees all keys, only all runs.
    """
    c = counts.select(key, n, F.floor(F.col(key) / group).alias("__g"))
    alone = Window.partitionBy(F.lit(0)).orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    runs = c.groupBy("__g").agg(F.sum(n).alias("__n")).select("__g", F.coalesce(F.sum("__n").over(alone), F.lit(0)).alias("__before"))
    own = Window.partitionBy("__g").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("__own", F.coalesce(F.sum(n).over(own), F.lit(0)))
    return c.join(runs, "__g").select(key, n, (F.col("__before") + F.col("__own")).alias(start))


def attach(rows: DataFrame, facts: DataFrame, key: str, spread: str | Column, total: int, n: str = "n") -> DataFrame:
    """rows left-joined with facts (one row for each key, n counts the key's rows), nulls matching nulls.

    Facts of hot keys are broadcast: there are fewer than HOT_SHARE of them whatever the data are.  The others are
    joined by a shuffle, to which rows of hot keys go spread by `spread`, so no task gets a large share of the rows.
    """
    values = [c for c in facts.columns if c not in (key, n)]
    hot = facts.filter(F.col(n) * HOT_SHARE > total).select(
        F.col(key).alias("__hk"), F.lit(True).alias("__hot"), *[F.col(c).alias(f"__h_{c}") for c in values])
    cold = facts.filter(F.col(n) * HOT_SHARE <= total).select(
        F.col(key).alias("__ck"), F.lit(0).alias("__cs"), *[F.col(c).alias(f"__c_{c}") for c in values])
    spread = F.col(spread) if isinstance(spread, str) else spread
    marked = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("__hk")), "left")
    marked = marked.withColumn("__s", F.when(F.col("__hot"), F.pmod(F.xxhash64(spread), F.lit(1 << 20)) + 1).otherwise(0).cast("int"))
    joined = marked.join(cold, F.col(key).eqNullSafe(F.col("__ck")) & (F.col("__s") == F.col("__cs")), "left")
    return joined.select(*rows.columns, *[
        F.when(F.col("__hot"), F.col(f"__h_{c}")).otherwise(F.col(f"__c_{c}")).alias(c) for c in values])


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key and the seed alone; null counts as a key of its own."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
