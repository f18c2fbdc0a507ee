"""What is published: selection, listings, notices, evidence, map features and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landrank.functions import text as X
from landrank.functions.measured import js_round
from landrank.operators.delta import union_by_priority

#: How evidence kinds are published, and how many unknown signals make a row low in evidence.
EVIDENCE_KINDS = {"county_owned_reo": "county_owned_reo", "listing": "listing", "upset_bid": "upset_bid_window_open"}
LOW_EVIDENCE = 3


class NotDerivable(ValueError):
    """A published score does not follow from its published signals."""


def selected(scored: DataFrame, evidenced: DataFrame, n: int, state: str, n_state: int, key: str = "record_id") -> DataFrame:
    """Evidenced rows, the first n by rank, and the largest of a state that are measured and not vetoed; each once."""
    a = scored.join(evidenced.select(key).distinct(), key, "left_semi")
    b = scored.filter("rank is not null").orderBy("rank", key).limit(n)
    c = scored.filter((F.col("state") == state) & F.col("acreage").isNotNull() & ~F.col("vetoed")).orderBy(F.col("acreage").desc(), key).limit(n_state)
    return union_by_priority([a, b, c], [key], ["acreage"])


def listing(df: DataFrame) -> DataFrame:
    """Scored rows (record_id, cheapness, components, roll, ...) as listings: rounded, with signals and what is unknown."""
    signals = F.transform("components", lambda c: F.struct(c["id"].alias("id"), js_round(c["normalized"], 4).alias("normalized"), c["effective"].alias("weight"), c["basis"].alias("why")))
    return df.withColumns({"score": F.col("roll.score"), "cheapness": js_round(F.col("cheapness"), 4), "signals": signals,
                           "low_evidence": F.col("roll.unknown_count") >= LOW_EVIDENCE}).drop("components", "roll")


def not_derivable(listings: DataFrame) -> DataFrame:
    """Listings whose score is not the weighted mean of their signals, rounded; must be empty."""
    weight = F.aggregate("signals", F.lit(0.0), lambda a, s: a + s["weight"])
    points = F.aggregate("signals", F.lit(0.0), lambda a, s: a + F.coalesce(s["normalized"] * s["weight"], F.lit(0.0)))
    mean = F.when(weight > 0, F.try_divide(points, F.nullif(weight, F.lit(0.0))))
    # signals are rounded to four places, so the mean may differ by as much
    return listings.filter(~(F.col("score").isNull() & mean.isNull()) & ~F.coalesce(F.abs(F.col("score") - mean) <= 0.5 + 1e-4, F.lit(False)))


def notices(found: DataFrame, coverage: DataFrame, today: Column) -> DataFrame:
    """Notices (title, state, county, opening_bid) with kind, sale date, fips by state and county, and whether they are live."""
    key = lambda s, c: F.lower(F.concat_ws("|", F.trim(s), F.trim(c)))
    c = coverage.select("fips", key("state", "county").alias("__k")).dropDuplicates(["__k"])
    out = found.withColumns({"kind": X.classify(F.col("title")), "sale_date": X.sale_date(F.col("title")), "__n": key("state", "county")})
    out = out.join(c, F.col("__n") == F.col("__k"), "left").drop("__n", "__k")
    days = F.datediff(F.to_date("sale_date"), today)
    return out.withColumns({"days_left": days, "live": days.isNull() | (days >= 0)})


def broken_notices(df: DataFrame) -> DataFrame:
    from landrank.operators.quality import violations

    return violations(df, {"state": F.length("state") == 2, "fips": F.col("fips").isNull() | F.col("fips").rlike(r"^\d{5}$"),
                           "bid": F.col("opening_bid").isNull() | (F.col("opening_bid") >= 0), "url": F.col("source_url").rlike("^https?://")})


def evidence(df: DataFrame) -> DataFrame:
    """Observations as evidence: kinds by name (others are dropped), the record's own URL first, prices above zero alone."""
    kind = F.create_map(*[F.lit(x) for kv in EVIDENCE_KINDS.items() for x in kv])[F.col("kind")]
    return df.withColumn("kind", kind).filter("kind is not null").withColumns({
        "source_url": F.coalesce("record_url", "source_url"), "price": F.when(F.col("price") > 0, F.col("price"))}).drop("record_url")


def any_known(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of which at least one of the columns is known."""
    return df.filter(F.coalesce(*columns).isNotNull())


def half_measured(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Rows in which a value and its unknown reason are both there, or neither: must be empty."""
    bad = None
    for value, reason in pairs.items():
        b = F.col(value).isNull() == F.col(reason).isNull()
        bad = b if bad is None else bad | b
    return df.filter(bad)


def bounds(df: DataFrame, lng: str = "lng", lat: str = "lat", default: tuple = (-85.8, 33.9, -77.9, 39.6)) -> DataFrame:
    names = ("minx", "miny", "maxx", "maxy")
    values = (F.min(lng), F.min(lat), F.max(lng), F.max(lat))
    return df.agg(*[F.coalesce(v, F.lit(d)).alias(n) for n, v, d in zip(names, values, default, strict=True)])


def clusters(df: DataFrame, per_degree: float) -> DataFrame:
    """Grid cells of a map with count, best score (-1 where none is known) and rows with known water."""
    cell = lambda c: F.floor(F.col(c) * per_degree)
    return df.filter("lng is not null and lat is not null").groupBy(cell("lng").alias("cx"), cell("lat").alias("cy")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce("score", F.lit(-1))).alias("best"), F.count_if(F.coalesce("has_water", F.lit(False))).alias("n_water"))


def averages(df: DataFrame, key: str, value: str) -> DataFrame:
    """The mean of known values, rounded; null where none is."""
    return df.groupBy(key).agg(js_round(F.avg(value)).alias("mean"), F.count(value).alias("n_known"))


def summary(df: DataFrame, key: str, kinds: list[str], kind: str) -> DataFrame:
    """Counts of each kind by key, a column a kind, zero where there is none."""
    return df.groupBy(key).pivot(kind, kinds).count().na.fill(0, kinds)


def features(df: DataFrame, properties: list[str]) -> DataFrame:
    """A GeoJSON feature for each row with coordinates."""
    f = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("lng", "lat").alias("coordinates")).alias("geometry"), F.struct(*properties).alias("properties"))
    return df.filter("lng is not null and lat is not null").select(F.to_json(f, {"ignoreNullFields": "false"}).alias("feature"))


def basis(component: Column, subject: Column) -> Column:
    """Why a signal is what it is, as a sentence."""
    return F.when(component["status"] == "unknown", F.format_string("%s of %s is unknown: %s.", component["id"], subject, component["basis"])).otherwise(
        F.format_string("%s of %s is %.1f of 100, with %.1f of its weight of %.0f.", component["id"], subject, component["normalized"], component["effective"], component["nominal"]))


def empty_copy(tier: Column, lane: Column, filtered: Column) -> Column:
    """Why a page shows no row: by what is collected there, by lane, and by the reader's filters."""
    return (F.when(filtered, "No row matches these filters; some may be left out because they are unknown.")
            .when(tier == "notices-only", "Only public notices are collected here, and none is live.").when(tier == "thin", "Little is collected here; an empty page says little.")
            .when(lane == "market", "No priced row is known here.").otherwise("Rows are collected here, and none is published."))


def water_label(names: Column, present: Column) -> Column:
    """Up to two names; water that is known without a name; nothing where it is unknown."""
    return F.when(F.size(names) > 0, F.array_join(F.slice(names, 1, 2), ", ")).when(present, "unnamed water").when(~present, "no water found")
