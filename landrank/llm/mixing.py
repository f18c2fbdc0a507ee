"""Mixing sources to target weights by Pareto order sampling, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landrank.llm.common import attach, uniform, word_count, written

SEED = 20
#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: The mix's size as a multiple of all sizes, and the most copies of a source or document.
SHARE, MOST = 1.5, 2
#: Rows of a rank bucket, about.
BUCKET_ROWS = 2000


def water_fill(df: DataFrame, by: list[str], weight: Column, cap: Column, budget: Column, tie: list[str]) -> DataFrame:
    """Adds `level`: the least level at which min(cap, weight * level), summed over the rows of `by`, is the budget.

    Rows at their cap are a prefix in the order of cap / weight, so one sorted pass finds the level; null if all rows
    are at their cap.  Rows of no weight never get anything.
    """
    w = df.withColumns({"__w": weight, "__c": cap, "__b": budget})
    w = w.withColumn("__r", F.when(F.col("__w") > 0, F.try_divide(F.col("__c"), F.col("__w"))).otherwise(F.lit(0.0)))
    w = w.withColumn("__cap", F.when(F.col("__w") > 0, F.col("__c")).otherwise(F.lit(0)))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = whole.orderBy("__r", *tie).rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumns({
        "__left": F.col("__b") - F.coalesce(F.sum("__cap").over(before), F.lit(0)),
        "__rest": F.sum("__w").over(whole) - F.coalesce(F.sum("__w").over(before), F.lit(0)),
        "__n": F.row_number().over(whole.orderBy("__r", *tie)),
    })
    at = F.when(F.col("__rest") > 0, F.try_divide(F.col("__left"), F.col("__rest")))
    first = F.min(F.when((F.col("__w") > 0) & (F.col("__r") > at), F.struct("__n", at.alias("at")))).over(whole)
    return w.withColumn("level", first["at"]).drop("__w", "__c", "__b", "__r", "__cap", "__left", "__rest", "__n")


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, n, source_size, target of each source: weights go round over the sources by code point, null last."""
    s = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    alone = Window.partitionBy(F.lit(0))
    order = F.pmod(F.row_number().over(alone.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    s = s.withColumn("__weight", F.element_at(F.array(*map(F.lit, weights)), order.cast("int") + 1))
    s = s.withColumn("__all", F.sum("source_size").over(alone))
    s = water_fill(s, [], F.col("__weight"), most * F.col("source_size"), share * F.col("__all"), ["source"])
    target = F.least((most * F.col("source_size")).cast("double"), F.coalesce(F.col("__weight") * F.col("level"), F.lit(float("inf"))))
    return s.select("source", "n", "source_size", target.alias("target"))


def draws(rows: DataFrame, seed: int, most: int) -> DataFrame:
    """rows (doc_id, size, tie, level) with whole (certain copies), p (inclusion odds of one more) and rank.

    The draw of a row depends on seed and doc_id; rows without an id draw by `tie`, a hash of their text.
    """
    expected = F.when(F.col("size") <= 0, 0.0).otherwise(
        F.least(F.lit(float(most)), F.coalesce(F.col("level") * F.log2(1.0 + F.col("size")), F.lit(float(most)))))
    u = uniform(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.col("tie"))), seed)
    rows = rows.withColumn("whole", F.floor(expected)).withColumn("p", expected - F.col("whole"))
    odds = F.try_divide(u / (1 - u), F.col("p") / (1 - F.col("p")))
    return rows.withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds)))


def plan(sized: DataFrame, seed: int = SEED, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """What the mix takes of each source: source, n, source_size, target, level, and where its sample ends.

    sized: doc_id, source, size, tie (a written table, as it is read several times).  A document's expected copies are
    min(most, level * log2(1 + size)), where its source's level makes the expected words the target.  Whole copies are
    certain.  What remains is an inclusion probability p; the documents of a source are ranked by
    (u / (1 - u)) / (p / (1 - p)), u being uniform and fixed by seed and doc_id, and are taken in that order as long as
    half of the next one fits the words that the target still lacks: a sample of fixed size in words.

    So the sample is a prefix in the order of (rank, doc_id, size, tie); `last` is its last member, and `ties` of the
    rows that equal that in all four are taken.  The end is found over buckets of the rank; only the documents of the
    bucket in which it lies are sorted.
    """
    total = sized.count()
    targets = written(source_targets(sized, weights, share, most), "targets")
    # the level at which documents of the source give its words: over the sizes that occur, not over documents
    lengths = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("k"))
    lengths = lengths.join(targets.select(F.col("source").alias("__s"), "target", "n"), F.col("source").eqNullSafe(F.col("__s")))
    words, appetite = F.col("size") * F.col("k"), F.log2(1.0 + F.col("size"))
    levels = water_fill(lengths, ["source"], appetite * words, most * words, F.col("target"), ["size"])
    levels = levels.groupBy("source").agg(F.max("level").alias("level"))
    facts = written(targets.join(levels.select(F.col("source").alias("__s"), "level"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s"), "levels")
    docs = draws(attach(sized, facts.select("source", "n", "target", "level"), "source", "tie", total), seed, most)
    buckets = max(16, total // BUCKET_ROWS)
    docs = written(docs.withColumn("bucket", F.floor(F.col("rank") * buckets).cast("int")).drop("level"), "ranked")
    ends = docs.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.sum(F.col("whole") * F.col("size")).alias("sure"))
    src = Window.partitionBy("source")
    up_to = src.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("sure", F.sum("sure").over(src)).filter(F.col("bucket").isNotNull())
    ends = ends.withColumn("start", F.coalesce(F.sum("words").over(up_to), F.lit(0)))
    ends = ends.join(facts.select(F.col("source").alias("__s"), "target", "n"), F.col("source").eqNullSafe(F.col("__s")))
    ends = ends.withColumn("lacking", F.col("target") - F.col("sure"))
    ends = ends.filter((F.col("start") <= F.col("lacking"))).groupBy("source").agg(
        F.max_by(F.struct(F.col("bucket").alias("last"), "start", "lacking"), "bucket").alias("end"), F.max("n").alias("n"))
    edge = attach(docs, ends, "source", "tie", total).filter(F.col("bucket") == F.col("end.last"))
    order = Window.partitionBy("source", "bucket").orderBy("rank", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    at = edge.withColumn("at", F.col("end.start") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    at = at.filter(F.col("at") + F.col("size") / 2 <= F.col("end.lacking"))
    place = F.struct("rank", "doc_id", "size", "tie")
    last = at.groupBy("source", place.alias("last")).agg(F.count(F.lit(1)).alias("ties")).groupBy("source").agg(F.max(F.struct("last", "ties")).alias("m"))
    # where the bucket has none, the sample ends with the bucket before
    last = ends.select(F.col("source").alias("__s"), F.col("end.last").alias("bucket")).join(
        last.select(F.col("source").alias("__t"), "m"), F.col("__s").eqNullSafe(F.col("__t")), "left")
    last = last.select("__s", F.col("m.last").alias("last"), F.coalesce("m.ties", F.lit(0)).alias("ties"),
                       F.when(F.col("m").isNull(), F.col("bucket") / F.lit(float(buckets))).alias("below"))
    return written(facts.join(last, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s"), "plan")


def applied(rows: DataFrame, mix: DataFrame, seed: int = SEED, most: int = MOST) -> DataFrame:
    """rows (doc_id, source, size, tie, and others) with source_size, target, copies and inclusion, by a plan of theirs.

    The plan holds a row a source and is attached to the rows, which stay where they are; only those that equal the last
    member of a sample are counted off.
    """
    total = mix.agg(F.sum("n").alias("n")).first()["n"] or 0
    facts = mix.select("source", "n", "source_size", "target", "level", "last", "ties", "below")
    docs = draws(attach(rows, facts, "source", "tie", total), seed, most)
    place, last = F.struct("rank", "doc_id", "size", "tie"), F.col("last")
    tied = F.coalesce(F.col("rank").isNotNull() & place.eqNullSafe(last), F.lit(False))
    before = F.coalesce(F.col("rank").isNotNull() & F.when(last.isNotNull(), place < last).otherwise(F.col("rank") < F.col("below")), F.lit(False))
    free = docs.filter(~tied).withColumn("extra", before.cast("int"))
    nth = Window.partitionBy("source").orderBy("rank")
    held = docs.filter(tied).withColumn("nth", F.row_number().over(nth)).withColumn("extra", (F.col("nth") <= F.col("ties")).cast("int")).drop("nth")
    out = free.unionByName(held)
    return out.select(*rows.columns, "source_size", "target", (F.col("whole") + F.col("extra")).cast("int").alias("copies"), F.col("p").alias("inclusion"))


def sizes() -> list[Column]:
    """doc_id, source, size in words, and tie, a hash of the text."""
    return [F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")]


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix of documents (doc_id, source, text): doc_id, size, source_size, target, taken, copies, source, inclusion.

    See plan().  Null or empty texts have size 0 and are taken 0 times; a very long text is one document like others; a
    null source is a source; rows that repeat a doc_id have the same draw and are ordered by size and text; no rows give
    no rows; other columns are not read.
    """
    sized = written(docs.select(*sizes()), "sized")
    out = applied(sized, plan(sized, **options), *[options[k] for k in ("seed",) if k in options])
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", "source", "inclusion")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """Each row of docs (doc_id, source, text and any other columns) as many times as the mix takes it; texts are not shuffled."""
    cols = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), *sizes())
    out = applied(held, plan(written(docs.select(*sizes()), "sized"), **options)).filter("copies > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return out.select(*[F.col("row").getField(c).alias(c) for c in cols])
