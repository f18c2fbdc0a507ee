"""The corpus: candidates, rows that can be scored, and the run that scores, vetoes and ranks all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landrank.functions import text as X
from landrank.functions.measured import clamp, js_round
from landrank.operators import cohorts as C
from landrank.operators import score
from landrank.operators.delta import first_wins

#: Acres of a candidate for enrichment, from and to.
ACRES = (2.0, 200.0)


class MissingCounties(ValueError):
    """Some of the counties asked for are not in the seed."""


def active(parcels: DataFrame, stale: bool = False) -> DataFrame:
    """Rows of the current snapshot, or all."""
    return parcels if stale else parcels.filter(F.col("status") == "active")


def candidates(parcels: DataFrame, n: int, counties: list[str] | None = None, acres: tuple = ACRES) -> DataFrame:
    """The n largest active rows that are not government's, have a parcel number and so many acres."""
    ok = ~F.coalesce(F.col("owner_is_government"), F.lit(False)) & F.col("acreage").between(*acres) & (F.coalesce("parno", F.lit("")) != "")
    out = active(parcels).filter(ok & F.col("fips").isin(counties) if counties else ok)
    return out.orderBy(F.col("acreage").desc(), F.col("record_id")).limit(n)


def by_ids(parcels: DataFrame, ids: DataFrame, key: str = "record_id") -> DataFrame:
    return parcels.join(ids.select(key).distinct(), key, "left_semi")


def excluded_reason(value: Column, acreage: Column) -> Column:
    """Why a row cannot be scored; null if it can."""
    return F.when(value.isNull() | (value <= 0), "value-unknown").when(acreage.isNull() | (acreage <= 0), "acreage-unknown")


def partitioned(parcels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that can be scored, the others with their reason)."""
    why = excluded_reason(F.col("value"), F.col("acreage"))
    return parcels.filter(why.isNull()), parcels.withColumn("reason", why).filter(F.col("reason").isNotNull())


def scored_corpus(parcels: DataFrame, enrichment: DataFrame, sales: DataFrame, observations: DataFrame, cfg: score.Config = score.Config(), floor_rows: int = 50) -> DataFrame:
    """parcels with components, roll, gates, vetoed, veto_reasons and cheapness.

    parcels: record_id, fips, parusedesc, siteadd, acreage, value, value_basis, vintage_age, owner_is_government;
    enrichment: record_id, frontage_m, flowline_m, waterbody_m, zone, slope, road_m, a row each; sales: record_id, price, a
    row each; observations: record_id, kind.  Percentiles are over all rows that can be scored, the vetoed included.
    """
    key = "record_id"
    kinds = score.distress_totals(observations, key, cfg)
    p = parcels.join(enrichment.withColumn("enriched", F.lit(True)), key, "left").join(sales.select(key, "price"), key, "left").join(kinds, key, "left")
    ok = excluded_reason(F.col("value"), F.col("acreage")).isNull()
    p = p.withColumns({"cohort": X.cohort_key(F.col("fips"), F.col("parusedesc"), F.col("acreage"), list(cfg.bands)),
                       "per_acre": F.when(ok, F.try_divide("value", "acreage")), "raw_discount": score.discount_raw(F.col("price"), F.col("value"))})
    p = C.at_floor(p, C.value_floors(parcels, "fips", "value", floor_rows), "fips", "value")
    p = C.midrank(p, "cohort", "per_acre", "percentile", "cohort_size")
    p = C.midrank(p, "fips", "raw_discount", "discount_percentile", "discount_size")
    c = F.col
    own = score.per_acre(c("value"), c("acreage"), c("at_floor"), c("percentile"), c("cohort_size"), cfg)
    signals = F.array(score.discount(c("price"), c("value"), c("value_basis"), c("vintage_age"), c("discount_percentile"), c("discount_size"), cfg),
                      score.distress(c("kinds"), c("total"), c("undeclared"), cfg),
                      score.water(c("frontage_m"), c("flowline_m"), c("waterbody_m"), c("enriched"), cfg), score.livability(c("zone"), c("slope"), c("road_m"), c("enriched"), cfg))
    gates = score.gates(c("owner_is_government"), c("price").isNotNull() | (F.coalesce("kinds", F.lit(0)) > 0), c("parusedesc"), c("siteadd"), c("acreage"), cfg)
    out = p.withColumns({"cheapness": own["normalized"], "why": own["basis"], "components": signals, "gates": gates})
    return out.withColumns({"roll": score.rolled_up(c("components")), "vetoed": score.vetoed(c("gates")), "veto_reasons": score.veto_reasons(c("gates"))})


def ranked(scored: DataFrame, n: int) -> DataFrame:
    """The first n rows that are not vetoed, by cheapness, with their rank."""
    return C.top_ranked(scored.filter(~F.col("vetoed") & F.col("cheapness").isNotNull()), [F.col("cheapness").desc(), F.col("record_id").asc()], n)


def matched_pins(pins: DataFrame, parcels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pins (fips, parno) with the record they match, pins that match none): of several records the least."""
    rows = active(parcels).groupBy("fips", "parno").agg(F.min("record_id").alias("record_id"))
    return pins.join(rows, ["fips", "parno"]), pins.join(rows, ["fips", "parno"], "left_anti")


def with_geometry(chosen: DataFrame, geometry: DataFrame, order: str) -> DataFrame:
    """Candidates with the geometry of their parcel number in their county, the first by `order`; those without are left out."""
    first = first_wins(geometry.select("fips", "parno", "rings", F.col(order).alias("__order")), ["fips", "parno"], ["__order"])
    return chosen.join(first.drop("__order"), ["fips", "parno"])


def sources_of(counties: DataFrame, seeds: DataFrame, registry: DataFrame) -> DataFrame:
    """fips with its seed's source (of several the least) and what the registry says of it; null where either has none."""
    s = seeds.groupBy("fips").agg(F.min("parcel_source").alias("source_id"))
    return counties.join(s, "fips", "left").join(registry, "source_id", "left")


def requested(seeds: DataFrame, fips: list[str]) -> DataFrame:
    """The seed's rows of the counties asked for; all must be there."""
    found = seeds.filter(F.col("fips").isin(fips))
    if missing := sorted(set(fips) - {r["fips"] for r in found.select("fips").distinct().collect()}):
        raise MissingCounties(", ".join(missing))
    return found


def ingested(seeds: DataFrame, runs: DataFrame) -> DataFrame:
    """The seed's counties with their run's status and rows; rows of a run that is not complete are unknown, not zero."""
    r = runs.select("fips", F.col("status").alias("ingest_status"), F.when(F.col("status") == "complete", F.col("rows")).alias("rows"))
    return seeds.join(r, "fips", "left").withColumn("ingest_status", F.coalesce("ingest_status", F.lit("not-run")))


def nulled_counts(staged: DataFrame, by: list[str]) -> DataFrame:
    """Rows whose deed date was nulled and whose value was zero, and rows in all."""
    return staged.groupBy(*by).agg(F.count_if(F.col("deed_date").isNull()).alias("deed_nulled"), F.count_if(F.col("value_unknown_reason") == "zero-sentinel").alias("zero_parval"),
                                   F.count(F.lit(1)).alias("n_rows"))


def provenance_counts(published: DataFrame) -> DataFrame:
    """One row: published rows with a record's URL, with a generic one alone, and with none."""
    record, generic = F.col("record_url").isNotNull(), F.col("generic_url").isNotNull()
    return published.agg(F.count_if(record).alias("with_record"), F.count_if(~record & generic).alias("with_generic"), F.count_if(~record & ~generic).alias("with_none"))


def choices(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of each column, in order: what facets offer."""
    parts = [df.select(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")).filter("value is not null").distinct() for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("facet", "value")


def score_band(x: Column) -> Column:
    """A meter's step from 1 to 5 for a score of up to 100."""
    return clamp(F.ceil(x / 20).cast("double"), 1, 5).cast("int")


def points_and_ceilings(components: Column) -> Column:
    """(id, points, ceiling) of each component, the largest ceiling first: how much it gives, and could give."""
    weight = F.aggregate(components, F.lit(0.0), lambda a, c: a + c["effective"])
    one = F.transform(components, lambda c: F.struct((-F.coalesce(F.try_divide(c["effective"], weight) * 100, F.lit(0.0))).alias("order"), c["id"].alias("id"), F.coalesce(
        F.try_divide(c["normalized"] * c["effective"], weight), F.lit(0.0)).alias("points")))
    return F.transform(F.array_sort(one), lambda c: F.struct(c["id"].alias("id"), js_round(c["points"], 2).alias("points"), js_round(-c["order"], 2).alias("ceiling")))


def every_kth(df: DataFrame, order: list[Column], most: int = 50) -> DataFrame:
    """At most `most` rows, evenly through the order: every k-th.

    Rows are numbered within ranges of the order and by the ranges' sizes, so that no task holds them all.
    """
    from landrank.session import checkpointed

    n = df.count()
    k, parts = max(1, -(-n // most)), max(1, n // 1_000_000)
    ranged = df.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id())
    ranged = checkpointed(ranged)  # ranges are drawn by sampling, and must be the same for rows and sizes
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.select("__range", F.coalesce(F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"))
    at = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    out = ranged.withColumn("__at", at).join(sizes, "__range").filter((F.col("__at") + F.col("__start")) % k == 0)
    return out.drop("__range", "__at", "__start")
