"""Cohorts: mid-rank percentiles, value floors, usable cohorts.

A cohort may hold a large part of all rows, so percentiles are not taken by a window over rows: values are counted
first (partly before the shuffle), and windows run over the distinct values of a cohort, or over runs of them where they
are many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Runs that the distinct values of a cohort are cut into, about, where it has at least so many.
RUNS, MANY = 64, 100_000


class MixedBasis(ValueError):
    """A cohort holds values on more than one basis."""


def runs(counts: DataFrame, n: int, many: int) -> DataFrame:
    """counts (__k, __v, __equal) with __run: values of a cohort with at least `many` distinct ones in about n ascending runs.

    Runs are cut at values that a hash draws, one to each of its n classes: whatever order rows come in, cuts are the
    same, and no cohort's values meet in a task for them.
    """
    h = F.xxhash64("__v")
    drawn = counts.groupBy("__k", F.pmod(h, F.lit(n)).alias("__j")).agg(F.min_by("__v", h).alias("__cut"), F.count(F.lit(1)).alias("__d"))
    cuts = drawn.groupBy(F.col("__k").alias("__kc")).agg(F.collect_list("__cut").alias("__cuts"), F.sum("__d").alias("__d")).filter(F.col("__d") >= many)
    out = counts.join(cuts, F.col("__k") == F.col("__kc"), "left")
    return out.withColumn("__run", F.coalesce(F.size(F.filter("__cuts", lambda c: c < F.col("__v"))), F.lit(0))).select("__k", "__v", "__equal", "__run")


def midrank(df: DataFrame, cohort: str, value: str, out: str = "percentile", size: str = "cohort_size", keep: Column | None = None,
            n_runs: int = RUNS, many: int = MANY) -> DataFrame:
    """df with (below + equal / 2) / n * 100 of each value in its cohort, and n.

    Rows without cohort or value, or for which keep is not true, count nowhere and get null; n is null only where the
    cohort is.  Of a cohort with very many distinct values (see runs()) no task holds more than a run and the runs' sums.
    """
    use = F.col(cohort).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    if keep is not None:
        use = use & F.coalesce(keep, F.lit(False))
    counts = df.filter(use).groupBy(F.col(cohort).alias("__k"), F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__equal"))
    counts = runs(counts, n_runs, many)
    whole, own = Window.partitionBy("__k"), Window.partitionBy("__k", "__run")
    earlier = lambda w, by: w.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy("__k", "__run").agg(F.sum("__equal").alias("__in"))
    sums = sums.select(F.col("__k").alias("__ks"), F.col("__run").alias("__rs"), F.coalesce(F.sum("__in").over(earlier(whole, "__run")), F.lit(0)).alias("__start"),
                       F.sum("__in").over(whole).alias("__n"))
    ranks = counts.withColumn("__below", F.coalesce(F.sum("__equal").over(earlier(own, "__v")), F.lit(0)))
    ranks = ranks.join(sums, (F.col("__k") == F.col("__ks")) & (F.col("__run") == F.col("__rs")))
    ranks = ranks.select("__k", "__v", "__n", ((F.col("__start") + F.col("__below") + F.col("__equal") / 2) / F.col("__n") * 100).alias("__p"))
    # rows that do not count find their cohort's size under a null value
    sizes = sums.groupBy(F.col("__ks").alias("__k")).agg(F.max("__n").alias("__n"))
    ranks = ranks.unionByName(sizes.select("__k", F.lit(None).cast(df.schema[value].dataType).alias("__v"), "__n", F.lit(None).cast("double").alias("__p")))
    joined = df.withColumn("__mine", F.when(use, F.col(value)))
    joined = joined.join(ranks, (F.col(cohort) == F.col("__k")) & F.col("__mine").eqNullSafe(F.col("__v")), "left")
    return joined.select(*df.columns, F.col("__p").alias(out), F.when(F.col(cohort).isNotNull(), F.coalesce("__n", F.lit(0))).alias(size))


def value_floors(df: DataFrame, key: str, value: str, least: int) -> DataFrame:
    """For each key its lowest positive value and how often it occurs, where that is at least `least`."""
    counts = df.filter(F.col(value) > 0).groupBy(key, value).agg(F.count(F.lit(1)).alias("floor_count"))
    low = counts.groupBy(key).agg(F.min(F.struct(F.col(value).alias("floor_value"), "floor_count")).alias("low"))
    return low.select(key, "low.floor_value", "low.floor_count").filter(F.col("floor_count") >= least)


def at_floor(df: DataFrame, floors: DataFrame, key: str, value: str) -> DataFrame:
    """df with at_floor: whether the value is exactly its key's floor."""
    f = floors.select(F.col(key).alias("__k"), "floor_value", "floor_count")
    out = df.join(f, F.col(key) == F.col("__k"), "left")
    return out.withColumn("at_floor", F.coalesce(F.col(value) == F.col("floor_value"), F.lit(False))).drop("__k")


def one_basis(df: DataFrame, cohort: str, basis: str) -> None:
    """Raises if a cohort mixes known bases."""
    mixed = df.filter(F.col(cohort).isNotNull() & (F.col(basis) != "unknown")).groupBy(cohort).agg(
        F.min(basis).alias("a"), F.max(basis).alias("b")).filter("a <> b").take(1)
    if mixed:
        raise MixedBasis(f"{mixed[0][0]}: {mixed[0][1]} and {mixed[0][2]}")


def usable(df: DataFrame, cohort: str, least: int) -> DataFrame:
    """One row: cohorts, and cohorts of at least `least` rows."""
    n = df.filter(F.col(cohort).isNotNull()).groupBy(cohort).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("cohorts"), F.count_if(F.col("n") >= least).alias("usable"))


def top_ranked(df: DataFrame, order: list[Column], n: int, out: str = "rank") -> DataFrame:
    """The first n rows in order, numbered: only those n meet in one task."""
    few = df.orderBy(*order).limit(n)
    return few.withColumn(out, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
