"""Listings: facets in which unknown is neither small nor large, lanes, coverage, status, user state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landrank.functions import text as X

#: Land uses of the land facet, and how many items and characters a reader may keep.
LAND_USES = ("Vacant land", "Timber", "Agricultural")
MOST_ITEMS, NOTE_LENGTH = 60, 2000
STALE_HOURS = 48


#: What readers see of lanes, tiers and signals.
LABELS = {"market": "For sale", "prospect": "Prospect", "rich": "Full coverage", "partial": "Partial coverage", "thin": "Thin coverage", "notices-only": "Notices only",
          "discount": "Discount", "distress": "Distress", "water": "Water", "livability": "Livability"}


def label(code: Column) -> Column:
    """What a code is called; one without a name stays as it is."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])[code], code)


def lane(price: Column) -> Column:
    return F.when(price.isNull(), "prospect").otherwise("market")


def facets(df: DataFrame, *, state: str = "all", county: str = "all", use: str = "all", min_score: float = 0, min_acres: float = 0, max_price: float = 0,
           water: bool = False, land: bool = False, no_flood: bool = False, evidenced: bool = False, lane_is: str = "both", query: str = "",
           land_uses: tuple = LAND_USES) -> DataFrame:
    """Rows of df (state, fips, use, score, acreage, price, has_water, in_flood, search) that match.

    A least score or acreage leaves out what is unknown; a highest price keeps it.  Water must be known; only a known
    flood plain is dropped.
    """
    f = F.lit(True)
    for value, column in ((state, "state"), (county, "fips"), (use, "use")):
        f = f & (F.col(column) == value) if value != "all" else f
    f = f & F.coalesce(F.col("score") >= min_score, F.lit(False)) if min_score > 0 else f
    f = f & F.coalesce(F.col("acreage") >= min_acres, F.lit(False)) if min_acres > 0 else f
    f = f & F.coalesce(F.col("price") <= max_price, F.lit(True)) if max_price > 0 else f
    f = f & F.coalesce(F.col("has_water"), F.lit(False)) if water else f
    f = f & F.coalesce(F.col("use").isin(*land_uses), F.lit(False)) if land else f
    f = f & ~F.coalesce(F.col("in_flood"), F.lit(False)) if no_flood else f
    f = f & F.col("price").isNotNull() if evidenced or lane_is == "market" else f
    f = f & F.col("price").isNull() if lane_is == "prospect" else f
    f = f & F.coalesce(F.contains("search", F.lit(query.lower())), F.lit(False)) if query else f
    return df.filter(f)


def search_text(*columns: str) -> Column:
    return F.lower(F.concat_ws(" ", *columns))


def facet_counts(counties: DataFrame, listings: DataFrame, key: str) -> DataFrame:
    """counties with how many listings each has."""
    n = listings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counties.join(n, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def display_order() -> list[Column]:
    return [F.coalesce("cheapness", F.lit(-1.0)).desc(), F.col("record_id").asc()]


def denied(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls with the first rule (ordinal, host, path) that its host, or a host above, and the path's beginning match.

    Rules are joined by host, each URL's host standing for itself and all above it, so no URL meets all rules.  "*."
    before a host changes nothing; a null path matches every one.
    """
    once = urls.select("url").distinct()  # a URL that many rows hold is looked up once
    labels = F.split(X.host(F.col("url")), r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = once.withColumn("__h", F.explode(above))
    r = rules.select(F.col("ordinal"), F.regexp_replace(F.lower("host"), r"^\*\.", "").alias("__r"), F.lower("path").alias("__path"))
    full = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1))
    hit = hosts.join(r, F.col("__h") == F.col("__r")).filter(F.col("__path").isNull() | F.startswith(full, F.col("__path")))
    first = hit.groupBy("url").agg(F.min("ordinal").alias("rule"))
    return urls.join(first, "url", "left")


def coverage(seeds: DataFrame, ledger: DataFrame, rows: DataFrame, published: DataFrame, scorable: DataFrame, key: str = "fips") -> DataFrame:
    """Each seed county with counts, data_state and note; a county without rows is not one with zero.

    seeds has parcel_source; ledger ingest_status; rows, published and scorable a count n.
    """
    out = seeds
    for name, d in (("n_rows", rows), ("published", published), ("scorable", scorable)):
        out = out.join(d.select(key, F.col("n").alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    out = out.join(ledger.select(key, "ingest_status"), key, "left")
    state = F.when(F.col("n_rows") > 0, "ingested").when(F.col("parcel_source").isNull(), "no-source").otherwise("not-run")
    note = (F.when(state != "ingested", state).when(F.col("published") > 0, "published").when(F.col("scorable") == 0, "no-scorable-signal").otherwise("zero-deals"))
    return out.withColumns({"data_state": state, "note": note,
                            "disagrees": (state == "ingested") & F.coalesce(F.col("ingest_status") != "complete", F.lit(False))})


def source_status(sources: DataFrame, runs: DataFrame, held: DataFrame) -> DataFrame:
    """Each source with last_success, last_attempt, rows and state, from its runs, else from what is held of it.

    runs: source_id, status, started_at, finished_at, rows; held: source_id, rows, last_ingested_at, complete.
    """
    ok, part = F.col("status").isin("ok", "complete"), F.col("status") == "partial"
    r = runs.groupBy("source_id").agg(
        F.max(F.when(ok | part, F.col("finished_at"))).alias("last_success"), F.max("started_at").alias("last_attempt"), F.max_by("rows", "started_at").alias("run_rows"),
        F.count_if(ok).alias("n_ok"), F.count_if(part).alias("n_part"), F.count(F.lit(1)).alias("n_runs"))
    h = held.filter(F.col("rows") > 0).groupBy("source_id").agg(F.sum("rows").alias("held_rows"), F.max("last_ingested_at").alias("held_at"),
                                                                 F.bool_and("complete").alias("complete"))
    j = sources.join(r, "source_id", "left").join(h, "source_id", "left")
    state = (F.when(F.col("n_runs").isNotNull(), F.when(F.col("last_success").isNull(), "failed").when((F.col("n_part") > 0) & (F.col("n_ok") == 0), "degraded").otherwise("ok"))
             .when(F.col("held_at").isNotNull(), F.when(F.col("complete"), "ok").otherwise("degraded")).otherwise("never-run"))
    ran = F.col("n_runs").isNotNull()
    return j.select(*sources.columns, F.when(ran, F.col("last_success")).otherwise(F.col("held_at")).alias("last_success"),
                    F.when(ran, F.col("last_attempt")).otherwise(F.col("held_at")).alias("last_attempt"),
                    F.when(ran, F.col("run_rows")).otherwise(F.col("held_rows")).alias("rows"), state.alias("state"))


def allow_listed(df: DataFrame, allowed: list[str]) -> DataFrame:
    """df's columns in the order of `allowed`; raises if there is one more."""
    if extra := sorted(set(df.columns) - set(allowed)):
        raise ValueError(f"columns not allowed: {extra}")
    return df.select(*[c for c in allowed if c in df.columns])


def provenance(source_id: Column, base: Column, fips: Column, parno: Column, generic: Column) -> Column:
    """A record's own URL, else a generic one with how to verify; a missing source says so."""
    record = F.when(base.isNotNull() & (F.coalesce(parno, F.lit("")) != ""), X.record_url(
        base, F.concat(F.lit("stcntyfips='"), fips, F.lit("' AND parno='"), F.replace(parno, F.lit("'"), F.lit("''")), F.lit("'"))))
    return F.struct(F.coalesce(source_id, F.lit("none")).alias("source_id"), F.when(source_id.isNotNull(), record).alias("record_url"),
                    F.when(source_id.isNull() | record.isNull(), generic).alias("generic_url"),
                    F.when(source_id.isNull(), "no-source").when(record.isNull(), "search-by-parcel").alias("how_to_verify"))


def linked_generic(df: DataFrame, by_fips: DataFrame, by_state: DataFrame) -> DataFrame:
    """df with url of its fips, else of its state."""
    a = by_fips.select("fips", F.col("url").alias("__a"))
    b = by_state.select("state", F.col("url").alias("__b"))
    return df.join(a, "fips", "left").join(b, "state", "left").withColumn("url", F.coalesce("__a", "__b")).drop("__a", "__b")


def imported(existing: DataFrame, incoming: DataFrame, key: str, order: str, most: int = MOST_ITEMS) -> DataFrame:
    """incoming with result added, duplicate or capped; the reader's list never grows past `most` items."""
    once = incoming.groupBy(key).agg(F.min(order).alias("__o"))
    fresh = once.join(existing.select(key), key, "left_anti").orderBy("__o", key).limit(most)
    room = existing.count()
    fresh = fresh.withColumn("__n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("__o", key))).filter(F.col("__n") + room <= most)
    out = incoming.join(existing.select(key).distinct().withColumn("__have", F.lit(True)), key, "left").join(fresh.select(key, "__o"), key, "left")
    return out.withColumn("result", F.when(F.col("__have"), "duplicate").when(F.col("__o") == F.col(order), "added").when(F.col("__o").isNotNull(), "duplicate")
                          .otherwise("capped")).drop("__have", "__o")


def noted(existing: DataFrame, incoming: DataFrame, key: str = "id", note: str = "note") -> DataFrame:
    """Notes after an import: blank ones are left out, long ones cut, existing ones never overwritten."""
    new = incoming.filter(F.trim(note) != "").select(key, F.substring(note, 1, NOTE_LENGTH).alias("__new"))
    both = existing.select(key, F.col(note).alias("__old")).join(new, key, "full_outer")
    return both.select(key, F.coalesce("__old", "__new").alias(note))
