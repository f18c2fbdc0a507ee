"""Staging, rules on text and dates, gates and the corpus run over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landrank.functions import dates as Y
from landrank.functions import hashing as H
from landrank.functions import text as X
from landrank.functions.measured import js_round
from landrank.operators import corpus, keys, publish, quality, score, search
from landrank.plans.ranking import table
from landrank.session import checkpointed

#: 2024-01-01 in epoch milliseconds.
NOW_MS = 1_704_067_200_000
YEAR = 31_556_952_000


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a county's raw rows: three to a parcel number, of which two are equal; unknowns as feeds carry them."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    v = F.floor(k / 3) * 2 + F.least(k % 3, F.lit(1))
    parno = F.when(F.floor(k / 3) % 50 == 7, "").when(F.floor(k / 3) % 50 == 8, F.lit(None).cast("string")).otherwise(F.concat(F.lit(" p "), F.floor(k / 3).cast("string")))
    return c.select(
        k.alias("OBJECTID"), parno.alias("parno"), F.lpad(F.col("c_nationkey") * 0 + F.floor(k / 3) % 7, 5, "0").alias("stcntyfips"), F.when(v % 4 != 0, "Alpha ").otherwise("").alias("cntyname"),
        (v * 37 % 1000 - 20).cast("string").alias("parval"), (v % 250 / F.lit(2.0)).alias("gisacres"), F.element_at(F.array(*map(F.lit, ("Assessed", " market", "Taxable", ""))), (v % 4 + 1).cast("int")).alias("parvaltype"),
        F.when(v % 5 == 0, "1900-01-01").when(v % 5 == 1, "0").otherwise((F.lit(NOW_MS) - v * 7 % 4000 * 86_400_000).cast("string")).alias("saledate"), F.lit("").alias("sourcedate"),
        F.element_at(F.array(*map(F.lit, ("Vacant  land", "GOVERNMENT", "HOA common area"))), (v % 3 + 1).cast("int")).alias("parusedesc"), F.lit(" ").alias("siteadd"),
        F.element_at(F.array(*map(F.lit, ("Smith Trust", "State of X", "", "Jane Roe"))), (v % 4 + 1).cast("int")).alias("ownname"), F.element_at(F.array(*map(F.lit, ("nc", "VA", ""))), (v % 3 + 1).cast("int")).alias("mstate"))


def _staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return keys.staged(_raw(spark, sf_dir), "NC", "Beta", NOW_MS)


def stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, _ = _staged(spark, sf_dir)
    return s.select("record_id", "county", "part_count", "acreage", "acreage_unknown_reason", "acreage_basis", "value", "value_unknown_reason", "value_basis", "sale_date", "sale_date_unknown_reason",
                    "owner_out_of_state", "owner_is_entity", "owner_is_government", "tenure_years")


def stage_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def stage_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulled dates, zero values and rows by county; and, as county "twice", record ids that occur more than once."""
    s, _ = _staged(spark, sf_dir)
    twice = keys.collisions(s).agg(F.lit("twice").alias("fips"), F.lit(0).cast("long").alias("deed_nulled"), F.lit(0).cast("long").alias("zero_parval"), F.count(F.lit(1)).alias("n_rows"))
    return corpus.nulled_counts(s, ["fips"]).unionByName(twice)


def stage_deeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a second state's rows: parts of an order in order of arrival."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey")
    arrival = (F.col("l_linenumber") * 10_000_000 + F.col("l_partkey")) * 100_000 + F.col("l_suppkey")
    x = F.col("l_suppkey") / F.lit(100.0)
    ring = F.array(F.array(x, F.lit(1.0)), F.array(x + 2, F.lit(1.0)), F.array(x + 2, F.lit(3.0)), F.array(x, F.lit(3.0)))
    raw = li.select(arrival.alias("OBJECTID"), F.when(F.col("l_orderkey") % 20 != 0, F.concat(F.lit("o "), F.col("l_orderkey"))).alias("PID"), F.lit(" Gamma").alias("COUNTY"), F.lit("47001").alias("FIPS"),
                    F.when(F.col("l_quantity") > 40, 0).otherwise(F.col("l_quantity")).alias("DEEDAC"), F.array(ring).alias("rings"), F.lit("x").alias("OWNER"))
    s, _ = keys.staged_deeded(raw, "TN", NOW_MS)
    return s.select("record_id", "part_count", "acreage", "acreage_unknown_reason", "acreage_basis", "value", "value_unknown_reason", "county", js_round(F.col("lng"), 4).alias("lng"), "lat")


def _corpus(spark: SparkSession, sf_dir: str) -> dict:
    """Customers as parcels, their orders as enrichment and sales, their events as observations."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    parcels = c.select(
        k.alias("record_id"), F.col("c_nationkey").cast("string").alias("fips"), F.col("c_mktsegment").alias("parusedesc"), F.when(k % 41 == 0, "rear R/W strip").otherwise("").alias("siteadd"),
        F.when(k % 6 != 0, k % 60 / F.lit(2.0)).alias("acreage"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("value"), F.when(k % 5 == 0, "net_of_exemptions").otherwise("market_equivalent").alias("value_basis"),
        (k % 11).alias("vintage_age"), (k % 17 == 0).alias("owner_is_government"))
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("record_id")).agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    d = F.col("n").cast("double")
    enrichment = o.select("record_id", F.when(F.col("n") > 15, d).alias("frontage_m"), (d * 20).alias("flowline_m"), F.when(F.col("n") > 5, d * 15).alias("waterbody_m"),
                          F.when(F.col("n") % 3 == 0, "AE").when(F.col("n") % 3 == 1, "X").alias("zone"), d.alias("slope"), F.when(F.col("n") % 2 == 0, d * 50).alias("road_m"))
    sales = o.filter("top < 250000").select("record_id", (F.col("top") / 100).alias("price"))
    kind = F.element_at(F.array(*map(F.lit, ("tax_sale_listed", "foreclosure_notice", "tax_delinquent"))), (F.col("event_id") % 3 + 1).cast("int"))
    observations = table(spark, sf_dir, "events").select(F.col("user_id").alias("record_id"), F.when(F.col("value") < 15, kind).alias("kind"))
    cfg = score.Config(min_cohort=5, discount_cohort=20, bands=(5, 10, 20))
    return {"parcels": parcels, "enrichment": enrichment, "sales": sales, "observations": observations, "cfg": cfg}


def corpus_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers scored, vetoed or not."""
    s = corpus.scored_corpus(**_corpus(spark, sf_dir), floor_rows=3)
    points = corpus.points_and_ceilings(F.col("components"))
    return s.select("record_id", js_round(F.col("cheapness"), 4).alias("cheapness"), "why", F.col("roll.score").alias("score"), F.col("roll.unknown_count").alias("unknown_count"),
                    js_round(F.col("roll.confidence"), 4).alias("confidence"), F.array_join("veto_reasons", ",").alias("vetoes"), corpus.score_band(F.col("roll.score")).alias("band"),
                    F.when(F.col("roll.denominator") > 0, points[0]["ceiling"]).alias("top_ceiling"))


def corpus_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = corpus.scored_corpus(**_corpus(spark, sf_dir), floor_rows=3)
    return corpus.ranked(s.withColumn("cheapness", js_round(F.col("cheapness"), 6)), 50).select("record_id", "rank", js_round(F.col("cheapness"), 4).alias("cheapness"))


def corpus_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    can, cannot = corpus.partitioned(_corpus(spark, sf_dir)["parcels"])
    return cannot.select("reason").unionByName(can.select(F.lit("scored").alias("reason"))).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _corpus(spark, sf_dir)["parcels"]
    k = F.col("record_id")
    return p.withColumns({"status": F.when(k % 8 == 0, "stale").otherwise("active"), "parno": F.when(k % 13 != 0, (k % 700).cast("string")).otherwise("")})


def candidate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.candidates(_snapshot(spark, sf_dir), 40).select("record_id", "acreage")


def candidate_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of suppliers' keys as candidates, with the geometry that parts' keys give."""
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("record_id"))
    chosen = corpus.by_ids(_snapshot(spark, sf_dir), ids)
    k = F.col("p_partkey")
    g = table(spark, sf_dir, "part").select((k % 25).cast("string").alias("fips"), (k % 700).cast("string").alias("parno"), F.array(F.array(F.array(k + F.lit(0.5)))).alias("rings"), k.alias("ordinal"))
    return corpus.with_geometry(chosen, g, "ordinal").select("record_id", "fips", "parno", F.col("rings")[0][0][0].alias("x"))


def pin_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' keys as pins: those that a current record matches, and how many match none."""
    k = F.col("o_orderkey")
    pins = table(spark, sf_dir, "orders").select(k.alias("pin"), (k % 25).cast("string").alias("fips"), (k % 701).cast("string").alias("parno"))
    hit, miss = corpus.matched_pins(pins, _snapshot(spark, sf_dir))
    return hit.select("pin", "record_id").unionByName(miss.agg(F.lit(-1).cast("long").alias("pin"), F.count(F.lit(1)).alias("record_id")))


def county_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations' source by region, and what a registry of regions says of it."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    seeds = n.filter("n_nationkey <> 3").select(F.col("n_nationkey").alias("fips"), F.concat(F.lit("s"), F.col("n_regionkey")).alias("parcel_source"))
    registry = r.filter("r_regionkey <> 4").select(F.concat(F.lit("s"), F.col("r_regionkey")).alias("source_id"), F.col("r_name").alias("owner"))
    return corpus.sources_of(n.select(F.col("n_nationkey").alias("fips")), seeds, registry).select("fips", "source_id", "owner")


def facet_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.choices(table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey"), ["c_mktsegment", "c_nationkey"])


def _provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    p = search.provenance(F.when(k % 5 != 0, F.lit("src")), F.when(k % 3 != 0, F.lit("https://x.test/q")), F.col("c_nationkey").cast("string"), F.when(k % 7 != 0, F.concat(F.lit("o'"), k)).otherwise(""), F.when(k % 2 == 0, F.lit("https://x.test/")))
    return table(spark, sf_dir, "customer").select(p.alias("p")).select("p.*")


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' record URLs where they have a source and a number, generic ones else: by how to verify them."""
    return _provenance(spark, sf_dir).groupBy("how_to_verify").agg(F.max("record_url").alias("last_url"), F.max("generic_url").alias("generic_url"), F.count(F.lit(1)).alias("n"))


def provenance_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.provenance_counts(_provenance(spark, sf_dir))


def text_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that parts' keys pick, and what the rules say of them."""
    k = F.col("p_partkey")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))
    zone, fcode, road = pick(("AE", " x", "D", "C1", "x", "B")), pick((46006, 46003, 46007, 39004, 43610, 1)), pick(("S1100", "S1400", "S9999"))
    url = pick(("https://a.test", "https://a.test/", "https://a.test/r?id=1", "ftp://b.test/x"))
    p = table(spark, sf_dir, "part").select("p_partkey", X.value_basis(pick((" assessed", "TAXABLE", "other"))).alias("basis"), X.is_entity(pick(("Acme LLC", "Jane Roe", " "))).alias("entity"), X.sfha(zone).alias("sfha"),
                                            X.flood_out(zone).alias("out_score"), X.flood_out(zone, exact=True).alias("out_site"), X.regime(fcode).alias("regime"), X.is_perennial_body(fcode).alias("perennial"),
                                            X.road_class(road).alias("road"), X.is_bare_origin(url).alias("bare"), X.host(url).alias("host"))
    return p


def text_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    x = F.when(k % 6 != 0, price)
    said = F.when(k % 4 == 0, "-").when(k % 4 == 1, " ").otherwise(F.concat(F.lit("$"), F.format_number(price, 2)))
    return o.select("o_orderkey", js_round(X.money(said), 2).alias("money"), X.show_money(x).alias("shown"), X.show_acres(F.floor(x / 100) / 10).alias("acres"), X.show_distance(F.floor(x / 1000) * 10.0 * F.when(k % 2 == 0, 1).otherwise(10)).alias("distance"), X.show_percent(x / 10000).alias("percent"))


def date_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    now = F.to_timestamp(F.lit("2000-01-01"))
    shown = F.when(F.col("o_orderkey") % 5 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("soon")
    return o.select("o_orderkey", Y.tenure_years(F.when(F.col("o_orderkey") % 7 != 0, ms), F.lit(946_684_800_000)).alias("tenure"), Y.vintage_years(F.year("o_orderdate"), now).alias("vintage"),
                    Y.iso(ms).alias("iso"), Y.iso_date(ms).alias("day"), F.when(Y.age_days(shown, now) < 1e9, Y.age_days(shown, now)).alias("age"), Y.month_key(F.col("o_orderdate").cast("timestamp")).alias("month"))


def health_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as responses: the first check that each fails."""
    k = F.col("o_orderkey")
    c = quality.healthy(F.when(k % 9 == 0, F.lit("denied")), F.when(k % 8 != 0, F.lit("f")), k % 5 == 0, k % 100, 10)
    return table(spark, sf_dir, "orders").groupBy(F.coalesce(c, F.lit("ok")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def oversized_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), (F.col("o_totalprice") * 500).cast("long").alias("length"))
    return quality.oversized(f)


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages' URLs, some cut to their origin or of another scheme: which rules they break."""
    p = table(spark, sf_dir, "pages")
    url = F.when(F.col("page_id") % 3 == 0, F.regexp_extract("url", r"^[a-z]+://[^/]+", 0)).when(F.col("page_id") % 3 == 1, F.regexp_replace("url", "^https?", "ftp")).otherwise(F.col("url"))
    return quality.dishonest_urls(p.select("page_id", url.alias("u")), "u").select("page_id", F.array_join("broken", ",").alias("broken"))


def stale_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's newest complete run, where it is too old; over users' runs together, one row or none."""
    e = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", "failed").otherwise("complete").alias("status"), F.col("ts").cast("timestamp").alias("finished_at"))
    return quality.stale_manifests(e, F.to_timestamp(F.lit("2025-01-01"))).select(js_round(F.col("age_days"), 3).alias("age_days"))


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's hash of what it holds, whatever its status, and of its key."""
    return table(spark, sf_dir, "orders").select("o_orderkey", H.row_hash(["o_custkey", "o_totalprice"]).alias("content"), H.row_hash(["o_orderkey"], H.ATTRIBUTE).alias("attribute"))


def generic_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("fips"), F.col("n_regionkey").alias("state"))
    return search.linked_generic(n, n.filter("fips % 4 = 0").select("fips", F.concat(F.lit("n"), "fips").alias("url")), n.filter("state <> 1").select("state", F.concat(F.lit("r"), "state").alias("url")).distinct())


def evidence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations: known kinds, the record's own URL first, positive prices."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, "upset_bid").when(k % 3 == 1, "listing").otherwise("gossip").alias("kind"),
                                              F.when(k % 2 == 0, F.concat(F.lit("r"), k)).alias("record_url"), F.lit("s").alias("source_url"), F.when(k % 5 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("price"))
    return publish.any_known(publish.evidence(o), ["price"]).select("o_orderkey", "kind", "source_url", "price")


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored customers as listings: how many are low in evidence, follow not from their signals, or hold broken signals."""
    # scored once, as three counts are taken of it
    s = checkpointed(corpus.scored_corpus(**_corpus(spark, sf_dir), floor_rows=3).select("record_id", "cheapness", "components", "roll"))
    li = publish.listing(s.select("record_id", "cheapness", "components", "roll"))
    count = lambda d, what: d.select(F.lit(what).alias("what"))
    rows = li.select(F.when(F.col("low_evidence"), "low-evidence").otherwise("listing").alias("what")).unionByName(count(publish.not_derivable(li), "not-derivable"))
    return rows.unionByName(count(score.incoherent(s), "incoherent")).groupBy("what").agg(F.count(F.lit(1)).alias("n"))


_RAW = f"""r AS (SELECT c_custkey AS k, c_custkey // 3 AS p, c_custkey // 3 * 2 + least(c_custkey % 3, 1) AS v FROM customer),
u AS (SELECT *, CASE WHEN p % 50 = 7 THEN 'empty-parno' WHEN p % 50 = 8 THEN 'null-parno' END AS why FROM r),
g AS (SELECT p, v, min(k) AS k FROM u WHERE why IS NULL GROUP BY 1, 2),
s AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY k) - 1 AS seq, count(*) OVER (PARTITION BY p)::INT AS parts, v * 37 % 1000 - 20 AS val, v % 250 / 2.0 AS ac, v * 7 % 4000 AS days,
  lpad((p % 7)::VARCHAR, 5, '0') AS fips FROM g)"""

_SCORED = """c AS (SELECT c_custkey AS id, c_nationkey::VARCHAR AS fips, upper(trim(c_mktsegment)) AS use, c_custkey % 41 = 0 AS strip, CASE WHEN c_custkey % 6 <> 0 THEN c_custkey % 60 / 2.0 END AS ac,
  CASE WHEN c_acctbal > 0 THEN c_acctbal END AS val, c_custkey % 5 = 0 AS net, c_custkey % 11 AS age, c_custkey % 17 = 0 AS gov FROM customer),
o AS (SELECT o_custkey AS id, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1),
ev AS (SELECT DISTINCT user_id AS id, event_id % 3 AS kind FROM events WHERE value < 15), kd AS (SELECT id, count(*) AS kinds, sum([40, 35, 30][kind + 1]) AS total FROM ev GROUP BY 1),
fl AS (SELECT fips, arg_min(n, val) AS fn, min(val) AS fv FROM (SELECT fips, val, count(*) AS n FROM c WHERE val > 0 GROUP BY 1, 2) GROUP BY 1),
j AS (SELECT c.*, n, CASE WHEN top < 250000 THEN top / 100 END AS price, kinds, total, coalesce(fn >= 3 AND val = fv, false) AS atf,
  CASE WHEN val > 0 AND ac > 0 THEN val / ac END AS pa, CASE WHEN ac > 0 THEN fips || '|' || use || '|' || CASE WHEN ac <= 5 THEN '0-5' WHEN ac <= 10 THEN '5-10' WHEN ac <= 20 THEN '10-20' ELSE '20+' END END AS co
  FROM c LEFT JOIN o USING (id) LEFT JOIN kd USING (id) LEFT JOIN fl USING (fips)),
d AS (SELECT *, CASE WHEN price IS NOT NULL AND val IS NOT NULL THEN 1 - price / val END AS raw FROM j),
w AS (SELECT *, count(pa) OVER (PARTITION BY co) AS cn, CASE WHEN pa IS NOT NULL AND co IS NOT NULL THEN (rank() OVER (PARTITION BY co ORDER BY pa NULLS LAST) - 1 + count(*) OVER (PARTITION BY co, pa) / 2) / count(pa) OVER (PARTITION BY co) * 100 END AS pct,
  count(raw) OVER (PARTITION BY fips) AS dn, CASE WHEN raw IS NOT NULL THEN (rank() OVER (PARTITION BY fips ORDER BY raw NULLS LAST) - 1 + count(*) OVER (PARTITION BY fips, raw) / 2) / count(raw) OVER (PARTITION BY fips) * 100 END AS dp FROM d),
x AS (SELECT *, CASE WHEN val IS NULL THEN 'value-unknown' WHEN ac IS NULL OR ac <= 0 THEN 'acreage-unknown' WHEN atf THEN 'value-floor' WHEN co IS NULL OR cn < 5 THEN 'thin-cohort' ELSE 'measured' END AS why,
  CASE WHEN price IS NULL OR val IS NULL OR net OR age > 8 THEN NULL WHEN dn >= 20 THEN dp WHEN raw <= 0 THEN 0 ELSE least(raw * 100, 100) END AS s1,
  38 * least(greatest(1 - 0.0625 * age, 0), 1) * CASE WHEN dn >= 20 THEN 1 ELSE 0.7 END AS w1, CASE WHEN kinds > 0 THEN least(total, 100) END AS s2,
  CASE WHEN n IS NULL THEN NULL WHEN n > 15 THEN 100 WHEN least(n * 20, CASE WHEN n > 5 THEN n * 15 END) < 100 THEN 70 WHEN least(n * 20, CASE WHEN n > 5 THEN n * 15 END) < 400 THEN 40 ELSE 0 END AS s3,
  CASE WHEN n IS NOT NULL THEN (coalesce(CASE n % 3 WHEN 0 THEN 0 WHEN 1 THEN 100 END, 0) + least(greatest(100 - n / 30 * 100, 0), 100) + CASE WHEN n % 2 = 0 THEN least(greatest(100 - n * 50 / 1000 * 100, 0), 100) ELSE 0 END)
    / (1 + (n % 3 < 2)::INT + (n % 2 = 0)::INT) END AS s4 FROM w),
y AS (SELECT *, CASE WHEN s1 IS NULL THEN 0 ELSE w1 END AS e1, CASE WHEN s2 IS NULL THEN 0 ELSE 31 END AS e2, CASE WHEN s3 IS NULL THEN 0 ELSE 19 END AS e3, CASE WHEN s4 IS NULL THEN 0 ELSE 12 END AS e4,
  CASE WHEN why = 'measured' THEN least(greatest(100 - pct, 0), 100) END AS cheap, gov AND price IS NULL AND coalesce(kinds, 0) = 0 AS g1 FROM x),
z AS (SELECT *, e1 + e2 + e3 + e4 AS den, (coalesce(s1 * e1, 0) + coalesce(s2 * e2, 0) + coalesce(s3 * e3, 0) + coalesce(s4 * e4, 0)) AS pts, coalesce(ac < 0.1, false) AS g4 FROM y)"""

_PROVEN = """p AS (SELECT *, c_custkey AS k, c_custkey % 5 <> 0 AND c_custkey % 3 <> 0 AND c_custkey % 7 <> 0 AS rec, c_custkey % 2 = 0 AS gen FROM customer),
u AS (SELECT *, CASE WHEN rec THEN 'https://x.test/q/query?where=' || 'stcntyfips%3D%27' || c_nationkey || '%27+AND+parno%3D%27o%27%27' || k || '%27&outFields=*&f=html' END AS url,
  CASE WHEN k % 5 = 0 THEN 'no-source' WHEN NOT rec THEN 'search-by-parcel' END AS how FROM p)"""
_SNAP = "n AS (SELECT *, id % 8 = 0 AS stale, CASE WHEN id % 13 <> 0 THEN (id % 700)::VARCHAR ELSE '' END AS parno FROM c)"
_SCORE = "CASE WHEN den > 0 THEN floor(pts / den + 0.5) / 1.0 END"

SQL = {
    "stage_rows": f"""WITH {_RAW} SELECT fips || ':P' || p || ':' || seq AS record_id, CASE WHEN v % 4 <> 0 THEN 'Alpha' ELSE 'Beta' END AS county, parts AS part_count, CASE WHEN ac > 0 THEN ac END AS acreage,
CASE WHEN ac = 0 THEN 'zero-sentinel' END AS acreage_unknown_reason, CASE WHEN ac > 0 THEN 'gis' ELSE 'unknown' END AS acreage_basis, CASE WHEN val > 0 THEN val::DOUBLE END AS value,
CASE WHEN val = 0 THEN 'zero-sentinel' WHEN val < 0 THEN 'negative' END AS value_unknown_reason, CASE v % 4 WHEN 0 THEN 'market_equivalent' WHEN 1 THEN 'market_equivalent' WHEN 2 THEN 'net_of_exemptions' ELSE 'unknown' END AS value_basis,
CASE WHEN v % 5 > 1 THEN ({NOW_MS} - days * 86400000)::DOUBLE END AS sale_date, CASE v % 5 WHEN 0 THEN 'date-sentinel' WHEN 1 THEN 'zero-sentinel' END AS sale_date_unknown_reason,
CASE v % 3 WHEN 0 THEN false WHEN 1 THEN true END AS owner_out_of_state, CASE v % 4 WHEN 0 THEN true WHEN 2 THEN NULL ELSE false END AS owner_is_entity, v % 4 = 1 OR v % 3 = 1 AS owner_is_government,
CASE WHEN v % 5 > 1 THEN floor(days * 86400000 / {YEAR}.0)::INT END AS tenure_years FROM s""",
    "stage_unkeyed": f"WITH {_RAW} SELECT why AS reason, count(*) AS n FROM u WHERE why IS NOT NULL GROUP BY 1",
    "stage_checks": f"WITH {_RAW} SELECT fips, count(*) AS deed_nulled, count(*) FILTER (val = 0) AS zero_parval, count(*) AS n_rows FROM s GROUP BY 1 UNION ALL SELECT 'twice', 0, 0, 0",
    "stage_deeded": """WITH s AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS seq, count(*) OVER (PARTITION BY l_orderkey)::INT AS parts FROM lineitem WHERE l_orderkey % 20 <> 0)
SELECT '47001:O' || l_orderkey || ':' || seq AS record_id, parts AS part_count, CASE WHEN l_quantity <= 40 THEN l_quantity::DOUBLE END AS acreage, CASE WHEN l_quantity > 40 THEN 'zero-sentinel' END AS acreage_unknown_reason,
CASE WHEN l_quantity <= 40 THEN 'deeded' ELSE 'unknown' END AS acreage_basis, NULL::DOUBLE AS value, 'not published by the state' AS value_unknown_reason, 'Gamma' AS county, floor((l_suppkey / 100.0 + 1) * 10000 + 0.5) / 10000 AS lng, 2.0 AS lat FROM s""",
    "corpus_scores": f"""WITH {_SCORED} SELECT id AS record_id, floor(cheap * 10000 + 0.5) / 10000 AS cheapness, why, {_SCORE} AS score, ((s1 IS NULL)::INT + (s2 IS NULL)::INT + (s3 IS NULL)::INT + (s4 IS NULL)::INT)::INT AS unknown_count,
floor(den / 100.0 * 10000 + 0.5) / 10000 AS confidence, concat_ws(',', CASE WHEN g1 THEN 'government' END, CASE WHEN strip THEN 'situs' END, CASE WHEN g4 THEN 'acreage' END) AS vetoes,
CASE WHEN den > 0 THEN least(greatest(ceil({_SCORE} / 20), 1), 5)::INT END AS band, CASE WHEN den > 0 THEN floor(greatest(e1, e2, e3, e4) / den * 100 * 100 + 0.5) / 100 END AS top_ceiling FROM z""",
    "corpus_ranks": f"""WITH {_SCORED}, r AS (SELECT id, floor(cheap * 1000000 + 0.5) / 1000000 AS c FROM z WHERE cheap IS NOT NULL AND NOT (g1 OR strip OR g4))
SELECT id AS record_id, row_number() OVER (ORDER BY c DESC, id)::INT AS rank, floor(c * 10000 + 0.5) / 10000 AS cheapness FROM r ORDER BY c DESC, id LIMIT 50""",
    "corpus_excluded": f"WITH {_SCORED} SELECT CASE WHEN val IS NULL THEN 'value-unknown' WHEN ac IS NULL OR ac <= 0 THEN 'acreage-unknown' ELSE 'scored' END AS reason, count(*) AS n FROM c GROUP BY 1",
    "candidate_rows": f"WITH {_SCORED}, {_SNAP} SELECT id AS record_id, ac AS acreage FROM n WHERE NOT stale AND NOT gov AND ac BETWEEN 2 AND 200 AND parno <> '' ORDER BY ac DESC, id LIMIT 40",
    "candidate_geometry": f"""WITH {_SCORED}, {_SNAP}, g AS (SELECT (p_partkey % 25)::VARCHAR AS fips, (p_partkey % 700)::VARCHAR AS parno, min(p_partkey) + 0.5::DOUBLE AS x FROM part GROUP BY 1, 2)
SELECT id AS record_id, fips, parno, x FROM n JOIN g USING (fips, parno) WHERE id IN (SELECT s_suppkey FROM supplier)""",
    "pin_matches": f"""WITH {_SCORED}, {_SNAP}, m AS (SELECT fips, parno, min(id) AS id FROM n WHERE NOT stale GROUP BY 1, 2),
t AS (SELECT o_orderkey AS pin, id FROM orders LEFT JOIN m ON fips = (o_orderkey % 25)::VARCHAR AND parno = (o_orderkey % 701)::VARCHAR)
SELECT pin, id AS record_id FROM t WHERE id IS NOT NULL UNION ALL SELECT -1, count(*) FROM t WHERE id IS NULL""",
    "county_sources": """SELECT n_nationkey AS fips, CASE WHEN n_nationkey <> 3 THEN 's' || n_regionkey END AS source_id, CASE WHEN n_nationkey <> 3 AND n_regionkey <> 4 THEN r_name END AS owner FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "facet_choices": "SELECT DISTINCT 'c_mktsegment' AS facet, c_mktsegment AS value FROM customer UNION ALL SELECT DISTINCT 'c_nationkey', c_nationkey::VARCHAR FROM customer",
    "provenance": f"""WITH {_PROVEN} SELECT how AS how_to_verify, max(url) AS last_url, max(CASE WHEN gen AND how IS NOT NULL THEN 'https://x.test/' END) AS generic_url, count(*) AS n FROM u GROUP BY 1""",
    "provenance_totals": f"""WITH {_PROVEN} SELECT count(*) FILTER (rec) AS with_record, count(*) FILTER (NOT rec AND gen) AS with_generic, count(*) FILTER (NOT rec AND NOT gen) AS with_none FROM u""",
    "text_codes": """SELECT p_partkey, ['market_equivalent', 'net_of_exemptions', 'unknown'][p_partkey % 3 + 1] AS basis, [true, false, NULL][p_partkey % 3 + 1] AS entity, [true, false, NULL, false, false, false][p_partkey % 6 + 1] AS sfha,
[false, false, false, true, true, true][p_partkey % 6 + 1] AS out_score, [false, false, false, false, true, true][p_partkey % 6 + 1] AS out_site,
['perennial', 'intermittent', 'ephemeral', 'unspecified', 'unspecified', 'unspecified'][p_partkey % 6 + 1] AS regime, [false, false, false, true, true, false][p_partkey % 6 + 1] AS perennial,
['primary', 'local', 'S9999'][p_partkey % 3 + 1] AS road, [true, true, false, false][p_partkey % 4 + 1] AS bare, ['a.test', 'a.test', 'a.test', 'b.test'][p_partkey % 4 + 1] AS host FROM part""",
    "text_formats": """WITH x AS (SELECT o_orderkey, o_totalprice AS t, CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS x, floor(o_totalprice / 1000) * 10 * CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 10 END AS d FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 1 THEN floor(t * 100 + 0.5) / 100 END AS money, CASE WHEN x IS NULL THEN 'unknown' ELSE '$' || format('{:,}', floor(x + 0.5)::BIGINT) END AS shown,
CASE WHEN x IS NULL THEN 'unknown' ELSE printf('%.1f', floor(x / 100) / 10) || ' ac' END AS acres,
CASE WHEN x IS NULL THEN 'unknown' WHEN d < 1000 THEN format('{:,}', d::BIGINT) || ' m' ELSE printf('%.1f', d / 1000) || ' km' END AS distance,
CASE WHEN x IS NULL THEN 'unknown' ELSE format('{:,}', floor(x / 10000 + 0.5)::BIGINT) || '%' END AS percent FROM x""",
    "date_rules": f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN greatest(0, floor((946684800000 - epoch_ms(o_orderdate)) / {YEAR}.0))::INT END AS tenure, (2000 - year(o_orderdate))::INT AS vintage,
strftime(o_orderdate, '%Y-%m-%dT00:00:00.000Z') AS iso, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 5 <> 0 THEN datediff('day', o_orderdate::DATE, DATE '2000-01-01')::DOUBLE END AS age, strftime(o_orderdate, '%Y-%m') AS month FROM orders""",
    "health_checks": """SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'in-band-error' WHEN o_orderkey % 8 = 0 THEN 'no-features' WHEN o_orderkey % 100 < 10 THEN 'row-floor' WHEN o_orderkey % 5 = 0 THEN 'transfer-limit' ELSE 'ok' END AS verdict,
count(*) AS n FROM orders GROUP BY 1""",
    "oversized_files": """WITH f AS (SELECT o_orderkey AS path, trunc(o_totalprice * 500)::BIGINT AS length FROM orders) SELECT path, length, CASE WHEN length > 104857600 THEN 'error' ELSE 'warning' END AS level FROM f WHERE length > 83886080""",
    "url_rules": """SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'bare-origin' ELSE 'scheme' END AS broken FROM pages WHERE page_id % 3 < 2 AND url IS NOT NULL""",
    "stale_runs": "SELECT floor((epoch_ms(TIMESTAMP '2025-01-01') - epoch_us(max(ts)) // 1000) / 86400000.0 * 1000 + 0.5) / 1000 AS age_days FROM events WHERE event_type <> 'error' HAVING age_days > 10",
    "run_states": """SELECT o_orderkey, substr(sha256('{"o_custkey":' || coalesce(o_custkey::VARCHAR, 'null') || ',"o_totalprice":' || coalesce(o_totalprice::VARCHAR, 'null') || '}'), 1, 32) AS content,
substr(sha256('{"o_orderkey":' || o_orderkey || '}'), 1, 16) AS attribute FROM orders""",
    "generic_links": "SELECT n_nationkey AS fips, n_regionkey AS state, CASE WHEN n_nationkey % 4 = 0 THEN 'n' || n_nationkey WHEN n_regionkey <> 1 THEN 'r' || n_regionkey END AS url FROM nation",
    "evidence_rows": """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'upset_bid_window_open' ELSE 'listing' END AS kind, CASE WHEN o_orderkey % 2 = 0 THEN 'r' || o_orderkey ELSE 's' END AS source_url, o_totalprice AS price
FROM orders WHERE o_orderkey % 3 < 2 AND o_orderkey % 5 <> 0 AND o_totalprice > 0""",
    "listing_rows": f"WITH {_SCORED} SELECT CASE WHEN (s1 IS NULL)::INT + (s2 IS NULL)::INT + (s3 IS NULL)::INT + (s4 IS NULL)::INT >= 3 THEN 'low-evidence' ELSE 'listing' END AS what, count(*) AS n FROM z GROUP BY 1",
}

QUERIES = {f.__name__: f for f in (
    stage_rows, stage_unkeyed, stage_checks, stage_deeded, corpus_scores, corpus_ranks, corpus_excluded, candidate_rows, candidate_geometry, pin_matches, county_sources, facet_choices, provenance, provenance_totals,
    text_codes, text_formats, date_rules, health_checks, oversized_files, url_rules, stale_runs, run_states, generic_links, evidence_rows, listing_rows)}
