"""Keys, snapshots, listings, pages, points and gates over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landrank.functions import dates as Y
from landrank.functions import measured as M
from landrank.functions import text as X
from landrank.operators import delta, geometry, keys, nearest, publish, quality, search
from landrank.plans.ranking import table
from landrank.sources import readers
from landrank.streaming.changelog import event_counts

NOW = "2024-02-01 00:00:00"
FIELDS = ["o_orderstatus", "o_totalprice", "o_orderpriority"]


def key_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of (order, line): distinct flags and statuses in the order of part and supplier."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    li = li.withColumn("ordinal", F.col("l_partkey") * 1_000_000 + F.col("l_suppkey"))
    k = keys.assign_keys(li, ["l_orderkey", "l_linenumber"], ["l_returnflag", "l_linestatus"], "ordinal")
    return k.groupBy("l_orderkey", "l_linenumber").agg(F.max("part_count").alias("parts"), F.min_by(F.concat("l_returnflag", "l_linestatus"), "part_seq").alias("first_part"))


def record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers keyed by nation and name; no key twice."""
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", X.record_id(F.lpad(F.col("s_nationkey").cast("string"), 5, "0"), X.normal_key(F.col("s_name")), F.lit(0)).alias("record_id"))


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """This run's orders, the snapshot before (some rows new, changed, gone or stale), and the partitions that completed."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", *FIELDS)
    k = F.col("o_orderkey")
    prior = o.filter(k % 11 != 0).withColumn("o_totalprice", F.when(k % 13 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    prior = prior.withColumn("status", F.when(k % 17 == 0, "stale").otherwise("active")).withColumn("first_seen", F.lit("2024-01-01")).withColumn("last_seen", F.lit("2024-01-15"))
    staged = o.filter(k % 19 != 0)
    complete = o.select("o_orderpriority").distinct().filter("o_orderpriority <> '5-LOW'")
    return staged, prior, complete


def delta_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged, prior, complete = _snapshots(spark, sf_dir)
    return delta.change_events(staged, prior, "o_orderkey", "o_orderpriority", FIELDS, complete).select("o_orderkey", "kind", "field", "before", "after")


def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged, prior, complete = _snapshots(spark, sf_dir)
    out = delta.carried_forward(staged, prior, "o_orderkey", "o_orderpriority", complete, F.lit("2024-02-01"))
    return out.select("o_orderkey", "status", "first_seen", "last_seen")


def write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged, prior, _ = _snapshots(spark, sf_dir)
    return delta.write_counts(staged, prior, "o_orderkey", FIELDS)


def ledger_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    n = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"))
    low = F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW")
    now = n.select("o_orderpriority", F.when(low, "not-run").otherwise("complete").alias("ingest_status"), F.when(~low, F.col("rows")).alias("rows"))
    prior = n.filter("o_orderpriority <> '1-URGENT'").select("o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", "not-run").otherwise("complete").alias("ingest_status"),
                                                             (F.col("rows") - 1).alias("rows"))
    return delta.ledger(now, prior, "o_orderpriority")


def unseen_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    index = delta.unseen(o.filter("o_orderkey % 2 = 0"), o.limit(0).select(F.lit("").alias("row_hash")))
    return delta.unseen(o, index).select("o_orderkey", "o_custkey")


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event, the later half of the events upserted over the earlier one."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return delta.upserted(e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1"), ["user_id"], "event_id").select("user_id", "event_id")


def point_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the total of their last order where they have one."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("amount"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("amount"), "o_orderkey")
    return delta.point_update(c, o, ["c_custkey"], ["amount"], "o_orderkey")


def recon_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 4).alias("rows"))
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("rows"))
    return delta.reconciled(o, li, "k").groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def rolling_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order counts by status under half of the median of the eight before."""
    d = table(spark, sf_dir, "orders").groupBy("o_orderstatus", F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("total"))
    return delta.rolling_floor(d, "o_orderstatus", "day", "total", 0.5).groupBy("o_orderstatus").agg(F.count_if("under_floor").alias("n_under"), F.count(F.lit(1)).alias("n_days"))


def vintage_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a year by nation key, or by the nation's name where the key is missing."""
    n = table(spark, sf_dir, "nation")
    v = n.select(F.when(F.col("n_nationkey") % 5 != 0, F.concat(F.col("n_nationkey").cast("string"), F.lit(" "))).alias("fips"), F.concat(F.lower("n_name"), F.lit(" ")).alias("county"),
                 (2000 + F.col("n_nationkey")).alias("last_reappraisal_year"))
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.select("c_custkey", F.col("c_nationkey").cast("string").alias("fips"), F.col("n_name").alias("county"))
    return keys.vintage_joined(c, v).select("c_custkey", "assessment_year")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("fips"), "n_name", F.when(F.col("n_regionkey") != 2, "src").alias("parcel_source"))
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("fips"))
    rows, published = s.agg(F.count_if(F.col("s_acctbal") < 1000).alias("n")), s.agg(F.count_if(F.col("s_acctbal") < 0).alias("n"))
    scorable = s.agg(F.count_if(F.col("s_acctbal") > 500).alias("n"))
    ledger = n.select("fips", F.when(F.col("fips") % 3 == 0, "partial").otherwise("complete").alias("ingest_status"))
    return search.coverage(n, ledger, rows, published, scorable).select("fips", "n_rows", "published", "data_state", "note", "disagrees")


def latest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runs by type: last success, last attempt, state."""
    e = table(spark, sf_dir, "events")
    runs = e.select(F.col("event_type").alias("source_id"), F.when(F.col("event_type") == "error", "failed").when(F.col("event_id") % 3 == 0, "partial").otherwise("complete").alias("status"),
                    F.col("ts").cast("timestamp").alias("started_at"), (F.col("ts").cast("timestamp") + F.expr("interval 1 minute")).alias("finished_at"), F.col("event_id").alias("rows"))
    sources = e.select(F.col("event_type").alias("source_id")).distinct()
    held = sources.select("source_id", F.lit(0).cast("long").alias("rows"), F.lit(None).cast("timestamp").alias("last_ingested_at"), F.lit(True).alias("complete"))
    return search.source_status(sources, runs, held).select("source_id", "rows", "state", F.unix_millis("last_attempt").alias("attempt_ms"))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.col("ts").cast("timestamp")).alias("last"))
    return e.groupBy(Y.freshness(F.col("last"), F.to_timestamp(F.lit(NOW)), 200).alias("state")).agg(F.count(F.lit(1)).alias("n"))


def facet_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as listings with unknown scores, sizes and prices."""
    return search.facets(_listings(spark, sf_dir), min_score=40, max_price=60, no_flood=True).select("record_id", "fips", "score", "price")


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("record_id"), F.lit("XX").alias("state"), F.col("c_nationkey").alias("fips"), F.col("c_mktsegment").alias("use"), F.when(k % 4 != 0, k % 100).alias("score"),
                    F.when(k % 3 != 0, k % 50).alias("acreage"), F.when(k % 5 != 0, k % 90).alias("price"), F.when(k % 7 != 0, k % 2 == 0).alias("has_water"),
                    F.when(k % 6 != 0, k % 9 == 0).alias("in_flood"), search.search_text("c_name", "c_mktsegment").alias("search"))


def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("fips"), "n_name")
    return search.facet_counts(n, search.facets(_listings(spark, sf_dir), water=True, min_acres=10, lane_is="market"), "fips")


def denylist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages' URLs against rules by host and path; the first rule counts."""
    rules = spark.createDataFrame([(0, "*.example.org", "/en"), (1, "example.org", None), (2, "*.example.net", "/fr/1")], "ordinal int, host string, path string")
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return search.denied(p, F.broadcast(rules)).select("page_id", "rule")


def html_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    t = F.trim(X.entities_decoded(F.regexp_extract("html", r"<title>([^<]*)</title>", 1)))
    return p.select("page_id", t.alias("title"), X.classify(t).alias("kind"))


def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of each page, the first of each target."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    rows = readers.html_rows(p, "html", r'<a href="([^"]+)">([^<]+)</a>', ["target", "label"], ["page_id"])
    return rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links"), F.min("target").alias("least_target"))


def pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.personal_values(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").select("doc_id", "emails", "phones", "numbers")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), (10 * F.col("embedding")[0].cast("double") - 81.8).alias("lng"), (10 * F.col("embedding")[1].cast("double") + 36.7).alias("lat"), "label")


def geo_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).groupBy(F.floor(F.col("lng") * 10).alias("cx"), F.floor(F.col("lat") * 10).alias("cy")).agg(F.count(F.lit(1)).alias("n"))


def geo_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).groupBy(geometry.inside(F.col("lng"), F.col("lat")).alias("inside")).agg(F.count(F.lit(1)).alias("n"))


def geo_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each vector's point the nearest point with label 1."""
    p = _points(spark, sf_dir)
    return nearest.nearest_points(p, p.filter("label = 1")).select("point_id", "feature_id", M.js_round(F.col("metres"), 1).alias("metres"))


def slope_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points' slopes against the mean of their label, the third component being the height."""
    e = table(spark, sf_dir, "embeddings")
    p = _points(spark, sf_dir).join(e.select(F.col("vec_id").alias("id"), (1000 * F.col("embedding")[2].cast("double")).alias("elevation")), "id")
    c = p.groupBy("label").agg(F.min_by(F.struct(F.col("lng").alias("lng0"), F.col("lat").alias("lat0"), F.col("elevation").alias("elevation0")), "id").alias("c"))
    j = p.join(c, "label").select("label", "lng", "lat", "elevation", "c.*")
    return geometry.slope_signal(j, "label").select("label", "range_m", "slope_mean")


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return e.groupBy("event_type").agg(F.sum(k).alias("total"), F.count_if(k.isNull()).alias("n_unknown"), F.max(k).alias("most"))


def label_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, y = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    j = d.join(y, "doc_id", "left")
    return j.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("n_labelled"), F.sum("toxic").alias("n_toxic"))


def set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' customers, their keys counted up by one, against customers: those that either side lacks."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") + 1).alias("k"))
    a = quality.missing_ids(c, o, "k").withColumn("side", F.lit("no-order"))
    return a.unionByName(quality.missing_ids(o, c, "k").withColumn("side", F.lit("no-customer")))


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first user turn and the turns of each conversation."""
    c = table(spark, sf_dir, "conversations")
    g = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("role") == "user", F.col("turn"))).alias("first_user"), F.countDistinct("role").alias("roles"))
    return g


def notes_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as notes over documents' first words: none is overwritten, long ones are cut."""
    old = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("note"))
    new = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("note"))
    return search.noted(old, new).select("id", F.length("note").alias("n"), F.substring("note", 1, 20).alias("head"))


def watchlist_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers imported to a list that already has some, up to its cap."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return search.imported(s.filter("id % 3 = 0"), s.filter("id % 2 = 0").withColumn("at", F.col("id")), "id", "at", 60).groupBy("result").agg(F.count(F.lit(1)).alias("n"))


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts by type, as the stream gives them."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return event_counts(e).select(F.unix_millis("start").alias("start_ms"), "event_type", "n", M.js_round(F.col("total"), 2).alias("total"))


def seed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a county seed: what breaks its rules."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    seeds = n.select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("fips"), F.col("r_name").alias("state"), F.when(F.col("n_nationkey") % 4 == 0, "odd").otherwise("rich").alias("tier"))
    return quality.coverage_seed(seeds, 37, {"ASIA": 5, "EUROPE": 6}, ("rich", "partial", "thin", "notices-only"))


_PRIOR = """p AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority,
  CASE WHEN o_orderkey % 17 = 0 THEN 'stale' ELSE 'active' END AS status FROM orders WHERE o_orderkey % 11 <> 0), s AS (SELECT * FROM orders WHERE o_orderkey % 19 <> 0)"""
_POINTS = "p AS (SELECT vec_id AS id, 10 * embedding[1]::DOUBLE - 81.8 AS lng, 10 * embedding[2]::DOUBLE + 36.7 AS lat, 1000 * embedding[3]::DOUBLE AS elevation, label FROM embeddings)"
_HAVERSINE = "2 * 6371008.8 * asin(sqrt(least(1.0, sin(radians({b}.lat - {a}.lat) / 2) ** 2 + cos(radians({a}.lat)) * cos(radians({b}.lat)) * sin(radians({b}.lng - {a}.lng) / 2) ** 2)))"

SQL = {
    "key_assign": """WITH g AS (SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS a, min(l_partkey * 1000000 + l_suppkey) AS o FROM lineitem GROUP BY 1, 2, 3)
SELECT l_orderkey, l_linenumber, count(*)::INT AS parts, arg_min(a, o) AS first_part FROM g GROUP BY 1, 2""",
    "record_ids": "SELECT s_suppkey, lpad(s_nationkey::VARCHAR, 5, '0') || ':' || regexp_replace(upper(trim(s_name)), '\\s+', '', 'g') || ':0' AS record_id FROM supplier",
    "delta_feed": f"""WITH {_PRIOR}, j AS (SELECT s.o_orderkey, s.o_totalprice AS n, p.o_totalprice AS o, p.status, p.o_orderkey AS pk FROM s LEFT JOIN p USING (o_orderkey))
SELECT o_orderkey, 'new' AS kind, NULL::VARCHAR AS field, NULL::VARCHAR AS before, NULL::VARCHAR AS after FROM j WHERE pk IS NULL
UNION ALL SELECT o_orderkey, 'changed', 'o_totalprice', o::VARCHAR, n::VARCHAR FROM j WHERE pk IS NOT NULL AND n <> o
UNION ALL SELECT o_orderkey, 'returned', NULL, NULL, NULL FROM j WHERE n = o AND status = 'stale'
UNION ALL SELECT o_orderkey, 'stale', NULL, NULL, NULL FROM p WHERE o_orderkey % 19 = 0 AND status <> 'stale' AND o_orderpriority <> '5-LOW'""",
    "carry_forward": f"""WITH {_PRIOR} SELECT o_orderkey, 'active' AS status, CASE WHEN o_orderkey % 11 <> 0 THEN '2024-01-01' ELSE '2024-02-01' END AS first_seen, '2024-02-01' AS last_seen FROM s
UNION ALL SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN 'stale' ELSE status END, '2024-01-01', '2024-01-15' FROM p WHERE o_orderkey % 19 = 0""",
    "write_counts": "SELECT count(*) FILTER (o_orderkey % 11 = 0) AS inserted, count(*) FILTER (o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0) AS changed, "
                    "count(*) FILTER (o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0) AS unchanged FROM orders WHERE o_orderkey % 19 <> 0",
    "ledger_choice": """SELECT o_orderpriority, CASE WHEN o_orderpriority = '5-LOW' THEN 'not-run' ELSE 'complete' END AS ingest_status,
CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '4-NOT SPECIFIED' THEN count(*) - 1 ELSE count(*) END AS rows FROM orders GROUP BY 1""",
    "unseen_rows": """SELECT o_orderkey, any_value(o_custkey) AS o_custkey FROM orders WHERE o_orderkey % 2 = 1 GROUP BY o_orderkey, o_custkey, o_orderstatus""",
    "upsert": "SELECT user_id, coalesce(max(event_id) FILTER (event_id % 2 = 1), max(event_id)) AS event_id FROM events GROUP BY 1",
    "point_update": "SELECT c_custkey, coalesce(arg_max(o_totalprice, o_orderkey), any_value(c_acctbal)) AS amount FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1",
    "recon_counts": """WITH a AS (SELECT o_orderkey AS k, o_orderkey % 4 AS r FROM orders), b AS (SELECT l_orderkey AS k, count(*) AS r FROM lineitem GROUP BY 1)
SELECT CASE WHEN a.r IS NULL THEN 'missing-in-ledger' WHEN b.r IS NULL THEN 'missing-in-truth' WHEN a.r <> b.r THEN 'mismatch' ELSE 'equal' END AS verdict, count(*) AS n FROM a FULL JOIN b ON a.k = b.k GROUP BY 1""",
    "rolling_floor": """WITH d AS (SELECT o_orderstatus, o_orderdate::DATE AS day, sum(o_totalprice) AS total FROM orders GROUP BY 1, 2),
m AS (SELECT *, quantile_cont(total, 0.5) OVER (PARTITION BY o_orderstatus ORDER BY day ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS med FROM d)
SELECT o_orderstatus, count(*) FILTER (coalesce(total < med * 0.5, false)) AS n_under, count(*) AS n_days FROM m GROUP BY 1""",
    "vintage_join": "SELECT c_custkey, (2000 + c_nationkey)::INT AS assessment_year FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "coverage": """WITH s AS (SELECT s_nationkey, count(*) FILTER (s_acctbal < 1000) AS r, count(*) FILTER (s_acctbal < 0) AS p, count(*) FILTER (s_acctbal > 500) AS k FROM supplier GROUP BY 1),
j AS (SELECT n_nationkey AS fips, n_regionkey, coalesce(r, 0) AS r, coalesce(p, 0) AS p, coalesce(k, 0) AS k FROM nation LEFT JOIN s ON n_nationkey = s_nationkey),
t AS (SELECT *, CASE WHEN r > 0 THEN 'ingested' WHEN n_regionkey = 2 THEN 'no-source' ELSE 'not-run' END AS st FROM j)
SELECT fips, r AS n_rows, p AS published, st AS data_state, CASE WHEN st <> 'ingested' THEN st WHEN p > 0 THEN 'published' WHEN k = 0 THEN 'no-scorable-signal' ELSE 'zero-deals' END AS note,
st = 'ingested' AND fips % 3 = 0 AS disagrees FROM t""",
    "latest_manifest": """SELECT event_type AS source_id, arg_max(event_id, ts) AS rows, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS state, epoch_us(max(ts)) // 1000 AS attempt_ms FROM events GROUP BY 1""",
    "freshness": f"""WITH l AS (SELECT user_id, epoch_ms(TIMESTAMP '{NOW}') - epoch_ms(max(ts)) AS ms FROM events GROUP BY 1)
SELECT CASE WHEN ms < 0 THEN 'unknown' WHEN ms / 3600000 <= 200 THEN 'ok' ELSE 'stale' END AS state, count(*) AS n FROM l GROUP BY 1""",
    "facet_search": """SELECT c_custkey AS record_id, c_nationkey AS fips, c_custkey % 100 AS score, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 90 END AS price FROM customer
WHERE c_custkey % 4 <> 0 AND c_custkey % 100 >= 40 AND (c_custkey % 5 = 0 OR c_custkey % 90 <= 60) AND NOT (c_custkey % 6 <> 0 AND c_custkey % 9 = 0)""",
    "facet_counts": """SELECT n_nationkey AS fips, n_name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_custkey % 7 <> 0 AND c_custkey % 2 = 0
AND c_custkey % 3 <> 0 AND c_custkey % 50 >= 10 AND c_custkey % 5 <> 0 GROUP BY 1, 2""",
    "denylist": """WITH u AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1)) AS h, lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^#]*)', 1)) AS p FROM pages)
SELECT page_id, CASE WHEN (h = 'example.org' OR h LIKE '%.example.org') AND starts_with(p, '/en') THEN 0 WHEN h = 'example.org' OR h LIKE '%.example.org' THEN 1
WHEN (h = 'example.net' OR h LIKE '%.example.net') AND starts_with(p, '/fr/1') THEN 2 END::INT AS rule FROM u""",
    "html_titles": """WITH t AS (SELECT page_id, trim(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp;', '&'), '&#39;', ''''), '&quot;', '"'), '&nbsp;', ' ')) AS title FROM pages)
SELECT page_id, title, CASE WHEN regexp_matches(title, '(?i)tax\\s*foreclosure') THEN 'tax-foreclosure' WHEN regexp_matches(title, '(?i)sale\\s+under\\s+power') THEN 'sale-under-power'
WHEN regexp_matches(title, '(?i)sheriff''?s?\\s+sale') THEN 'sheriff-sale' ELSE 'county-notice' END AS kind FROM t""",
    "html_links": """WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]+)">([^<]+)</a>', 1)) AS t FROM pages) SELECT page_id, count(DISTINCT t) AS n_links, min(t) AS least_target FROM a GROUP BY 1""",
    "pii_scan": """WITH c AS (SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'))::INT AS emails, len(regexp_extract_all(text, '\\(\\d{3}\\) \\d{3}-\\d{4}'))::INT AS phones,
len(regexp_extract_all(text, '\\b\\d{3}-\\d{2}-\\d{4}\\b'))::INT AS numbers FROM documents) SELECT * FROM c WHERE emails > 0 OR phones > 0 OR numbers > 0""",
    "geo_cells": f"WITH {_POINTS} SELECT floor(lng * 10)::BIGINT AS cx, floor(lat * 10)::BIGINT AS cy, count(*) AS n FROM p GROUP BY 1, 2",
    "geo_envelope": f"WITH {_POINTS} SELECT lng BETWEEN -85.8 AND -77.9 AND lat BETWEEN 33.9 AND 39.6 AS inside, count(*) AS n FROM p GROUP BY 1",
    "geo_nearest": f"""WITH {_POINTS}, f AS (SELECT * FROM p WHERE label = 1), d AS (SELECT p.id, f.id AS fid, {_HAVERSINE.format(a='p', b='f')} AS m FROM p, f), b AS (SELECT id, min((m, fid)) AS k FROM d GROUP BY 1)
SELECT p.id AS point_id, k[2]::BIGINT AS feature_id, floor(k[1] * 10 + 0.5) / 10 AS metres FROM p LEFT JOIN b USING (id)""",
    "slope_samples": f"""WITH {_POINTS}, c AS (SELECT label, arg_min(lng, id) AS lng, arg_min(lat, id) AS lat, arg_min(elevation, id) AS e FROM p GROUP BY 1),
d AS (SELECT p.label, p.elevation, abs(p.elevation - c.e) AS rise, {_HAVERSINE.format(a='c', b='p')} AS run FROM p JOIN c USING (label))
SELECT label, floor((max(elevation) - min(elevation)) * 10 + 0.5) / 10 AS range_m, floor(avg(CASE WHEN run >= 1 THEN rise / run * 100 END) * 10 + 0.5) / 10 AS slope_mean FROM d GROUP BY 1""",
    "json_props": """SELECT event_type, sum(CAST(json_extract_string(props, '$.k') AS INT))::BIGINT AS total, count(*) FILTER (json_extract_string(props, '$.k') IS NULL) AS n_unknown,
max(CAST(json_extract_string(props, '$.k') AS INT)) AS most FROM events GROUP BY 1""",
    "label_left": "SELECT lang, count(*) AS n, count(quality) AS n_labelled, sum(toxic)::BIGINT AS n_toxic FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
    "set_diff": """SELECT DISTINCT c_custkey AS k, 'no-order' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey + 1 FROM orders)
UNION ALL SELECT DISTINCT o_custkey + 1, 'no-customer' FROM orders WHERE o_custkey + 1 NOT IN (SELECT c_custkey FROM customer)""",
    "conversation_turns": "SELECT conv_id, count(*) AS n, min(turn) FILTER (role = 'user') AS first_user, count(DISTINCT role) AS roles FROM conversations GROUP BY 1",
    "notes_import": """WITH n AS (SELECT doc_id AS id, substr(text, 1, 2000) AS note FROM documents WHERE trim(text) <> ''), j AS (SELECT coalesce(b.item_id, n.id) AS id, coalesce(b.text, n.note) AS note FROM benchmark b FULL JOIN n ON b.item_id = n.id)
SELECT id, length(note)::INT AS n, substr(note, 1, 20) AS head FROM j""",
    "watchlist_import": """WITH i AS (SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 2 = 0), h AS (SELECT count(*) AS have FROM supplier WHERE s_suppkey % 3 = 0),
f AS (SELECT id, row_number() OVER (ORDER BY id) AS k FROM i WHERE id % 3 <> 0), r AS (SELECT CASE WHEN i.id % 3 = 0 THEN 'duplicate' WHEN k + have <= 60 THEN 'added' ELSE 'capped' END AS result FROM i LEFT JOIN f USING (id), h)
SELECT result, count(*) AS n FROM r GROUP BY 1""",
    "event_windows": "SELECT epoch_ms(date_trunc('hour', ts)) AS start_ms, event_type, count(*) AS n, floor(sum(value) * 100 + 0.5) / 100 AS total FROM events GROUP BY 1, 2",
    "seed_gate": """WITH s AS (SELECT lpad(n_nationkey::VARCHAR, 5, '0') AS fips, r_name AS state, n_nationkey % 4 = 0 AS odd FROM nation JOIN region ON n_regionkey = r_regionkey),
k AS (SELECT state, count(*) AS n FROM s GROUP BY 1)
SELECT fips AS subject, 'tier' AS rule FROM s WHERE odd UNION ALL SELECT fips, 'duplicate' FROM s GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT state, 'state-count' FROM k WHERE NOT coalesce(n = CASE state WHEN 'ASIA' THEN 5 WHEN 'EUROPE' THEN 6 END, false)
UNION ALL SELECT count(*)::VARCHAR, 'row-count' FROM s HAVING count(*) <> 37""",
}

QUERIES = {f.__name__: f for f in (
    key_assign, record_ids, delta_feed, carry_forward, write_counts, ledger_choice, unseen_rows, upsert, point_update, recon_counts, rolling_floor, vintage_join,
    coverage, latest_manifest, freshness, facet_search, facet_counts, denylist, html_titles, html_links, pii_scan, geo_cells, geo_envelope, geo_nearest,
    slope_samples, json_props, label_left, set_diff, conversation_turns, notes_import, watchlist_import, event_windows, seed_gate)}


# -- publishing ------------------------------------------------------------------------------------------------------

def selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as scored rows: evidenced ones, the first 50 by price, the 30 largest of a status."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    s = o.select(k.alias("record_id"), F.col("o_orderstatus").alias("state"), F.when(k % 5 != 0, k % 977).cast("double").alias("acreage"), (k % 8 == 0).alias("vetoed"),
                 F.when(k % 4 == 1, k).alias("rank"))
    return publish.selected(s, s.filter("record_id % 500 = 3"), 50, "F", 30).select("record_id", "priority")


def map_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _points(spark, sf_dir).withColumns({"score": F.when(F.col("id") % 3 != 0, F.col("id") % 100), "has_water": F.when(F.col("id") % 5 != 0, F.col("label") == 2)})
    return publish.clusters(p, 2)


def map_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = publish.bounds(_points(spark, sf_dir))
    return b.select(*[M.js_round(F.col(c), 4).alias(c) for c in b.columns])


def county_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return publish.averages(c.select("c_nationkey", M.positive_quantity(F.col("c_acctbal"))["value"].alias("v")), "c_nationkey", "v")


def tier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus")
    return publish.summary(o, "o_orderpriority", ["F", "O", "P"], "o_orderstatus")


def notice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' notices, by nation, with dates in their titles."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    title = F.concat(F.when(k % 3 == 0, "Tax Foreclosure of ").when(k % 3 == 1, "Sale under power, ").otherwise("Notice "), "s_name", F.when(k % 4 != 0, F.concat(F.lit(" on March "), (k % 28 + 1).cast("string"), F.lit(", 2024"))).otherwise(""))
    found = s.select("s_suppkey", title.alias("title"), F.lit("XX").alias("state"), F.concat(F.lit(" "), F.lower("n_name")).alias("county"))
    cov = table(spark, sf_dir, "nation").filter("n_nationkey % 6 <> 0").select(F.col("n_nationkey").alias("fips"), F.lit("xx").alias("state"), F.upper("n_name").alias("county"))
    return publish.notices(found, cov, F.to_date(F.lit("2024-03-15"))).select("s_suppkey", "kind", "sale_date", "fips", "days_left", "live")


def geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many features there are, and how long their text is with whole coordinates."""
    p = _points(spark, sf_dir).select("id", F.floor("lng").alias("lng"), F.floor("lat").alias("lat"), "label")
    return publish.features(p, ["id", "label"])


SQL |= {
    "selection": """WITH s AS (SELECT o_orderkey AS id, o_orderstatus AS st, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 977 END AS a, o_orderkey % 8 = 0 AS v, CASE WHEN o_orderkey % 4 = 1 THEN o_orderkey END AS r FROM orders),
b AS (SELECT id FROM s WHERE r IS NOT NULL ORDER BY r LIMIT 50), c AS (SELECT id FROM s WHERE st = 'F' AND a IS NOT NULL AND NOT v ORDER BY a DESC, id LIMIT 30),
u AS (SELECT id, 0 AS p FROM s WHERE id % 500 = 3 UNION ALL SELECT id, 1 FROM b UNION ALL SELECT id, 2 FROM c) SELECT id AS record_id, min(p)::INT AS priority FROM u GROUP BY 1""",
    "map_clusters": f"""WITH {_POINTS} SELECT floor(lng * 2)::BIGINT AS cx, floor(lat * 2)::BIGINT AS cy, count(*) AS n, max(CASE WHEN id % 3 <> 0 THEN id % 100 ELSE -1 END) AS best,
count(*) FILTER (id % 5 <> 0 AND label = 2) AS n_water FROM p GROUP BY 1, 2""",
    "map_bounds": f"""WITH {_POINTS} SELECT floor(min(lng) * 10000 + 0.5) / 10000 AS minx, floor(min(lat) * 10000 + 0.5) / 10000 AS miny, floor(max(lng) * 10000 + 0.5) / 10000 AS maxx,
floor(max(lat) * 10000 + 0.5) / 10000 AS maxy FROM p""",
    "county_average": "SELECT c_nationkey, floor(avg(CASE WHEN c_acctbal > 0 THEN c_acctbal END) + 0.5) / 1.0 AS mean, count(*) FILTER (c_acctbal > 0) AS n_known FROM customer GROUP BY 1",
    "tier_summary": "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1",
    "notice_rows": """WITH n AS (SELECT s_suppkey, s_nationkey, CASE s_suppkey % 3 WHEN 0 THEN 'tax-foreclosure' WHEN 1 THEN 'sale-under-power' ELSE 'county-notice' END AS kind,
CASE WHEN s_suppkey % 4 <> 0 THEN '2024-03-' || lpad((s_suppkey % 28 + 1)::VARCHAR, 2, '0') END AS d FROM supplier)
SELECT s_suppkey, kind, d AS sale_date, CASE WHEN s_nationkey % 6 <> 0 THEN s_nationkey END AS fips, (s_suppkey % 28 + 1 - 15)::INT * CASE WHEN d IS NULL THEN NULL ELSE 1 END AS days_left,
d IS NULL OR s_suppkey % 28 + 1 >= 15 AS live FROM n""",
    "geojson": f"""WITH {_POINTS} SELECT '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || floor(lng)::BIGINT || ',' || floor(lat)::BIGINT || ']}},"properties":{{"id":' || id || ',"label":' || label || '}}}}' AS feature FROM p""",
}

QUERIES |= {f.__name__: f for f in (selection, map_clusters, map_bounds, county_average, tier_summary, notice_rows, geojson)}
