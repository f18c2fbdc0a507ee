"""Readers and writers over files that Spark makes of the driver's tables, and gates over them."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landrank.functions import dates as Y
from landrank.functions.measured import js_round
from landrank.operators import corpus, delta, publish, quality, search
from landrank.operators.quality import GateError
from landrank.plans.feeds import _points
from landrank.plans.ranking import table
from landrank.session import shared_folder
from landrank.sources import buckets, readers, writers

TODAY = "2024-03-15"


def reader_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as landed pages of 500 features each, read back with the fields that are asked for."""
    c, path = table(spark, sf_dir, "customer"), shared_folder(spark)
    k = F.col("c_custkey")
    attributes = F.create_map(F.lit("PARNO"), k.cast("string"), F.lit("Acres"), (k % 90).cast("string"), F.lit("unused"), F.lit("x"))
    point = F.struct((k / 1000).alias("x"), F.lit(36.0).alias("y"))
    pages = c.groupBy(F.floor(k / 500).alias("page")).agg(F.collect_list(F.struct(attributes.alias("attributes"), point.alias("geometry"))).alias("features"))
    pages.select("page", F.to_json(F.struct("features", F.lit(False).alias("exceededTransferLimit"))).alias("value")).write.partitionBy("page").text(path)
    f = readers.features(readers.feature_pages(spark, path), ["parno", "acres"])
    return readers.points(f.select("parno", "acres", "geometry.x", "geometry.y")).select(F.col("parno").cast("long").alias("parno"), F.col("acres").cast("long").alias("acres"), js_round(F.col("x"), 3).alias("x"))


def reader_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as geometries of their order: all rings of an order, one after the other."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    x = F.col("l_partkey").cast("double")
    f = li.select("l_orderkey", ((F.col("l_linenumber") * 10_000_000 + F.col("l_partkey")) * 100_000 + F.col("l_suppkey")).alias("ordinal"), F.array(F.array(F.array(x, x))).alias("rings"))
    r = readers.concatenated_rings(f, "l_orderkey")
    return r.select("l_orderkey", F.size("rings").alias("n"), F.element_at("rings", 1)[0][0].alias("first"), F.element_at("rings", -1)[0][0].alias("last"))


def reader_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a county seed with spaces in its cells."""
    s, path = table(spark, sf_dir, "supplier"), shared_folder(spark)
    k = F.col("s_suppkey").cast("string")
    s.select(F.concat(k, F.lit("  ")).alias("fips"), F.lit("NC").alias("state"), F.concat(F.lit(" "), F.col("s_name")).alias("county"), F.lit("r").alias("region"), F.lit("rich").alias("tier"),
             F.lit(None).cast("string").alias("parcel_source"), F.lit(" x ").alias("notes")).write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.csv(spark, path, readers.SEEDS).select(F.col("fips").cast("long").alias("fips"), "county", "parcel_source", "notes")


def reader_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a type as a run's manifest; one more file does not parse."""
    e, path = table(spark, sf_dir, "events"), shared_folder(spark)
    m = e.groupBy(F.col("event_type").alias("run_id")).agg(F.lit("s").alias("source_id"), F.lit("complete").alias("status"), F.count(F.lit(1)).alias("rows"))
    m = m.select(F.col("run_id").alias("file"), F.to_json(F.struct("run_id", "source_id", "status", "rows")).alias("value"))
    broken = table(spark, sf_dir, "region").filter("r_regionkey = 0").select(F.lit("broken").alias("file"), F.lit("{ not json").alias("value"))
    m.unionByName(broken).write.partitionBy("file").text(path)
    return readers.manifests(spark, path).select("run_id", "status", "rows")


def reader_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as one document that maps their keys to values."""
    n, path = table(spark, sf_dir, "nation"), shared_folder(spark)
    entry = F.struct(F.col("n_nationkey").cast("string"), F.struct(F.col("n_name").alias("kind"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey").cast("double")).alias("price")))
    n.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).write.text(path)
    return readers.keyed_map(spark, path, "struct<kind:string,price:double>").select(F.col("id").cast("long").alias("id"), "kind", "price")


def pin_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as documents of two table rows each, as text extraction flattens them."""
    k = F.col("s_suppkey")
    pin = lambda tail: F.concat(F.lpad((k % 10_000).cast("string"), 4, "0"), F.lit(f"-{tail}-"), F.lpad((k % 9973).cast("string"), 4, "0"))
    text = F.concat(F.lit("Heading"), pin("11"), F.lit("$1,"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("somewhere3/2019"), F.lit("12/2021"), pin("22"), F.lit("$"), (k % 900 + 1).cast("string"), F.lit("place"))
    return readers.pin_rows(table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("text"))).select("s_suppkey", "pin", "assessed_usd", "acquired")


@F.pandas_udf(T.BinaryType())
def _as_pdf(first: pd.Series, second: pd.Series, scanned: pd.Series) -> pd.Series:
    """Two texts as streams of a PDF, with one that is no text between them; a scanned one has an image alone."""
    def shown(text: str) -> bytes:
        escaped = text.replace("\\", "\\\\").replace("(", "\\(").replace(")", "\\)")
        return b"stream\n" + zlib.compress(f"BT ({escaped[:5]}) Tj ({escaped[5:]} ) Tj ET".encode("latin-1")) + b"\nendstream\n"

    noise = b"stream\nimage (not shown)\nendstream\n"
    return pd.Series([b"%PDF-1.4\n" + noise if s else b"%PDF-1.4 /Font\n" + shown(a) + noise + shown(b) for a, b, s in zip(first, second, scanned, strict=True)])


def pdf_pins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as PDFs with a table row in each of two streams, cut where a row goes on; those with a negative balance are scans."""
    k, owed = F.col("s_suppkey"), F.format_number(F.floor(F.abs("s_acctbal")), 0)
    pin = lambda tail: F.concat(F.lpad((k % 10_000).cast("string"), 4, "0"), F.lit(f"-{tail}-"), F.lpad((k % 9973).cast("string"), 4, "0"))
    first = F.concat(F.lit("Head (ing) "), pin("11"), F.lit("$"), owed, F.lit(" some where 3/2019 12/20"))
    second = F.concat(F.lit("21 "), pin("22"), F.lit("$"), (k % 900 + 1).cast("string"), F.lit(" place"))
    files = table(spark, sf_dir, "supplier").select("s_suppkey", _as_pdf(first, second, F.col("s_acctbal") < 0).alias("content"))
    flat = readers.pdf_flattened(files, ["s_suppkey"])
    rows = readers.pin_rows(flat).select("s_suppkey", "has_text", "pin", "assessed_usd", "acquired")
    none = flat.filter("not has_text").select("s_suppkey", "has_text", *[F.lit(None).cast(t).alias(c) for c, t in (("pin", "string"), ("assessed_usd", "double"), ("acquired", "string"))])
    return rows.unionByName(none)


def elevations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a point service's answers, some of them no answer."""
    k = F.col("event_id")
    body = F.when(k % 5 == 0, "Service down").when(k % 5 == 1, "{}").when(k % 5 == 2, '{"value": "-1000000"}').otherwise(F.concat(F.lit('{"value": "'), F.floor("value").cast("string"), F.lit('.5"}')))
    return table(spark, sf_dir, "events").select("event_id", readers.parsed_elevation(body).alias("e")).select("event_id", "e.elevation", "e.unknown_reason")


def log_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' statuses as change logs of three runs, each appended once."""
    o, path = table(spark, sf_dir, "orders"), shared_folder(spark)
    for run, status in (("2024-01-02", "F"), ("2024-01-09", "O"), ("2024-02-01", "P")):
        writers.append_once(o.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus"), path, run)
    log = spark.read.schema("o_orderkey long, o_orderstatus string, month string, run_id string").json(path)
    return log.groupBy("month", "run_id", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last"))


def pointer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' latest events in two versions behind a pointer; the second is what it points to."""
    e, path = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), shared_folder(spark)
    first = writers.write_upsert(e.filter("event_type = 'view'"), path, "v1", ["user_id"], "event_id")
    writers.swap_pointer(spark, path, first, "d1")
    second = writers.write_upsert(e.filter("event_type <> 'view'"), path, "v2", ["user_id"], "event_id", writers.read_pointer(spark, path)["current"])
    writers.swap_pointer(spark, path, second, "d2")
    writers.swap_pointer(spark, path, first, "d3", failed=1)
    return spark.read.parquet(writers.read_pointer(spark, path)["current"]).groupBy("user_id").agg(F.max("event_id").alias("event_id"))


def bucket_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in buckets by customer; orders of few customers get a new price, and new rows come in: the table afterwards."""
    o, path = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", F.lit(1).alias("seen")), shared_folder(spark)
    buckets.merge(o.filter("o_orderkey % 100 <> 7"), path, "v1", ["o_custkey", "o_orderkey"], "seen", by=["o_custkey"])
    changed = o.filter("o_custkey between 10 and 19 or o_orderkey % 100 = 7 and o_custkey < 20").withColumns({"o_totalprice": F.col("o_totalprice") + 1, "seen": F.lit(2)})
    buckets.merge(changed, path, "v2", ["o_custkey", "o_orderkey"], "seen")
    return buckets.read(spark, path)


def gated_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers behind gates that are measured as rows are written: the values of a write that passed, and that one that did not left no trace."""
    c, path = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.lit(1).alias("seen")), shared_folder(spark)
    gates = {"rows": (F.count(F.lit(1)), lambda n: n > 0), "negative": (F.count_if(F.col("c_acctbal") < 0), lambda n: n >= 0), "nameless": (F.count_if(F.col("c_custkey").isNull()), lambda n: n == 0),
             "greatest": (F.max("c_acctbal"), lambda x: x < 1e6)}
    good = buckets.merge(c, path, "v1", ["c_custkey"], "seen", gates=gates, buckets=8)
    try:
        buckets.merge(c.withColumns({"c_acctbal": F.lit(1e7), "seen": F.lit(2)}), path, "v2", ["c_custkey"], "seen", gates=gates)
    except GateError as e:
        failed = str(e).split(" ")[0]
    now = buckets.read(spark, path).agg(F.lit("now").alias("gate"), F.max("c_acctbal").alias("value"), F.lit(failed).alias("failed"))
    rows = [(name, float(value), None) for name, value in good["values"].items()]
    return spark.createDataFrame(rows, "gate string, value double, failed string").unionByName(now)


def ledger_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations' claimed customers, some wrong, set right by a count."""
    n = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("fips")).agg(F.count(F.lit(1)).alias("rows"))
    claimed = n.select("fips", F.when(F.col("fips") % 3 == 0, F.col("rows") - 1).when(F.col("fips") % 3 == 1, F.col("rows")).alias("rows"), F.lit(7).alias("inserted"))
    return delta.repaired(claimed, n, "fips", ["inserted"])


def mirror_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as files on both sides, some changed, some on one side alone."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part")
    a = p.filter(F.col("p_brand") != "Brand#11").select(k.alias("path"), F.sha2("p_name", 256).alias("sha"), F.length("p_name").alias("bytes"))
    b = p.filter(F.col("p_brand") != "Brand#12").select(k.alias("path"), F.concat(F.lit("sha256:"), F.upper(F.sha2(F.when(F.col("p_size") % 5 == 0, F.lit("old")).otherwise(F.col("p_name")), 256))).alias("sha"))
    return delta.mirror_plan(a, b).groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))


def registry_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a source registry: which rules they break."""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(
        F.when(k % 10 == 3, (k - 1).cast("string")).otherwise(k.cast("string")).alias("source_id"), F.when(k % 7 == 0, "https://a.test/").otherwise("https://a.test/x").alias("url"),
        F.when(k % 6 == 0, 2.0).otherwise(0.5).alias("rps"), F.when(k % 4 != 0, 10).alias("floor"), F.when(k % 8 == 4, "rich").otherwise("thin").alias("tier"),
        F.date_sub(F.to_date(F.lit(TODAY)), (k % 100).cast("int")).alias("verified_on"))
    return quality.registry(s, F.to_date(F.lit(TODAY)))


def payload_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that hold a word which must not be published."""
    return quality.needles(table(spark, sf_dir, "pages").select("page_id", "html"), "html", ["<script", "copyright", "</table>"]).select("page_id", "needle")


def half_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in which a value and its reason are both there, or neither."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 != 0, F.col("o_totalprice")).alias("v"), F.when((k % 3 == 0) | (k % 50 == 1), "why").alias("r"))
    return publish.half_measured(o.withColumn("r", F.when(k % 99 != 0, F.col("r"))), {"v": "r"}).select("o_orderkey")


def notice_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 5 == 0, "N").otherwise("NC").alias("state"), F.when(k % 3 == 0, "37x01").when(k % 3 == 1, "37001").alias("fips"),
                                                F.when(k % 4 != 0, F.col("s_acctbal")).alias("opening_bid"), F.when(k % 7 == 0, "mailto:x").otherwise("https://a.test/n").alias("source_url"))
    return publish.broken_notices(s).select("s_suppkey", F.array_join("broken", ",").alias("broken"))


def copy_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see: labels, empty pages and water, by codes that customers' keys pick."""
    k = F.col("c_custkey")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))
    names = F.array_repeat(F.lit("Creek"), (k % 3).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", search.label(pick(("market", "rich", "odd"))).alias("label"), publish.empty_copy(pick(("thin", "notices-only", "rich")), pick(("market", "prospect")), k % 5 == 0).alias("said"),
                                                   publish.water_label(names, F.when(k % 4 != 0, k % 2 == 0)).alias("water"), search.lane(F.when(k % 2 == 0, F.col("c_acctbal"))).alias("lane"))


def basis_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a component of an order is what it is: unknown without a high price, else its value and weights."""
    known = F.col("o_totalprice") > 200_000
    part = F.struct(F.concat(F.lit("c"), "o_orderstatus").alias("id"), F.when(known, "scored").otherwise("unknown").alias("status"), F.concat(F.lit("no price above "), F.floor("o_totalprice")).alias("basis"),
                    F.floor(F.col("o_totalprice") / 10_000).cast("double").alias("normalized"), (F.col("o_custkey") % 8 / 2).alias("effective"), F.lit(20.0).alias("nominal"))
    return table(spark, sf_dir, "orders").select("o_orderkey", publish.basis(part, F.concat(F.lit("order "), "o_orderkey")).alias("said"))


def display_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 customers as a page orders them: by cheapness, unknown ones last."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("record_id"), F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal") % 1000).cast("double").alias("cheapness"))
    return search.allow_listed(c, ["record_id", "cheapness", "score"]).orderBy(*search.display_order()).limit(100)


def recomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' prices against those of a recomputation."""
    k = F.col("o_orderkey")
    old = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return delta.recompute_counts(old, old.withColumn("o_totalprice", F.col("o_totalprice") + F.when(k % 3 == 0, 1).when(k % 3 == 1, -1).otherwise(0)), "o_orderkey", "o_totalprice")


def newest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.retained(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id")


def geo_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every k-th point by its id, at most 50."""
    return corpus.every_kth(_points(spark, sf_dir).select("id", "label"), [F.col("id")], 50)


def geo_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a layer that have a key and coordinates."""
    p = _points(spark, sf_dir)
    key: Column = F.when(F.col("id") % 4 != 0, F.col("id").cast("string")).otherwise(" ")
    return readers.points(p.select("id", key.alias("parno"), F.when(F.col("label") != 2, F.col("lng")).alias("x"), F.col("lat").alias("y"))).select("id")


def published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations, and customers with their segments, published as one version and read back."""
    n, c = table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    path = writers.published({"coverage": n, "listings": c}, shared_folder(spark), "v1")
    rows = spark.read.schema("c_custkey long, c_mktsegment string").json(f"{path}/listings").groupBy(F.col("c_mktsegment").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(spark.read.schema("n_nationkey long, n_name string").json(f"{path}/coverage").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("n")))


def cached_or_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of parts from a cache of the large ones, and from the landed table where the cache has none."""
    p = table(spark, sf_dir, "part")
    cache = p.filter("p_size > 25").select("p_partkey", (F.col("p_retailprice") + 1).alias("price"))
    return delta.union_by_priority([cache, p.select("p_partkey", F.col("p_retailprice").alias("price"))], ["p_partkey"], ["price"])


def ingest_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with a run of theirs: customers are its rows, and balances say how it ended."""
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("fips")).agg(F.count(F.lit(1)).alias("rows"), F.min("c_acctbal").alias("low"))
    runs = c.filter("fips % 6 <> 0").select("fips", "rows", F.when(F.col("fips") % 4 == 1, "partial").otherwise("complete").alias("status"))
    return corpus.ingested(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("fips")), runs)


def epoch_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as milliseconds, seconds, or not at all, by status."""
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    known = F.when(F.col("o_orderstatus") == "F", ms).when(F.col("o_orderstatus") == "O", (ms / 1000).cast("long"))
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(Y.epoch_unit(known, F.lit(1_893_456_000_000)).alias("unit"))


SQL = {
    "published_tables": "SELECT c_mktsegment AS name, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT n_name, n_nationkey FROM nation",
    "cached_or_landed": "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_retailprice + 1 ELSE p_retailprice END AS price, CASE WHEN p_size > 25 THEN 0 ELSE 1 END::INT AS priority FROM part",
    "ingest_coverage": """WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) SELECT n_nationkey AS fips, CASE WHEN n IS NULL OR n_nationkey % 6 = 0 THEN 'not-run' WHEN n_nationkey % 4 = 1 THEN 'partial' ELSE 'complete' END AS ingest_status,
CASE WHEN n_nationkey % 6 <> 0 AND n_nationkey % 4 <> 1 THEN n END AS rows FROM nation LEFT JOIN c ON c_nationkey = n_nationkey""",
    "epoch_units": "SELECT DISTINCT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'ms' WHEN 'O' THEN 'seconds' ELSE 'none-known' END AS unit FROM orders",
    "reader_pages": "SELECT c_custkey AS parno, c_custkey % 90 AS acres, floor(c_custkey / 1000 * 1000 + 0.5) / 1000 AS x FROM customer",
    "reader_rings": """SELECT l_orderkey, count(*)::INT AS n, arg_min(l_partkey, (l_linenumber * 10000000::BIGINT + l_partkey) * 100000 + l_suppkey)::DOUBLE AS first,
arg_max(l_partkey, (l_linenumber * 10000000::BIGINT + l_partkey) * 100000 + l_suppkey)::DOUBLE AS last FROM lineitem GROUP BY 1""",
    "reader_csv": "SELECT s_suppkey AS fips, s_name AS county, NULL::VARCHAR AS parcel_source, 'x' AS notes FROM supplier",
    "reader_manifests": "SELECT event_type AS run_id, 'complete' AS status, count(*) AS rows FROM events GROUP BY 1",
    "reader_map": "SELECT n_nationkey AS id, n_name AS kind, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey::DOUBLE END AS price FROM nation",
    "pin_table": """WITH p AS (SELECT s_suppkey, lpad((s_suppkey % 10000)::VARCHAR, 4, '0') AS a, lpad((s_suppkey % 9973)::VARCHAR, 4, '0') AS b FROM supplier)
SELECT s_suppkey, a || '-11-' || b AS pin, 1000.0 + s_suppkey % 1000 AS assessed_usd, '2021-12' AS acquired FROM p UNION ALL SELECT s_suppkey, a || '-22-' || b, (s_suppkey % 900 + 1)::DOUBLE, NULL FROM p""",
    "pdf_pins": """WITH p AS (SELECT s_suppkey, s_acctbal AS b, lpad((s_suppkey % 10000)::VARCHAR, 4, '0') AS x, lpad((s_suppkey % 9973)::VARCHAR, 4, '0') AS y FROM supplier)
SELECT s_suppkey, true AS has_text, x || '-11-' || y AS pin, floor(b) AS assessed_usd, '2021-12' AS acquired FROM p WHERE b >= 0 UNION ALL SELECT s_suppkey, true, x || '-22-' || y, (s_suppkey % 900 + 1)::DOUBLE, NULL FROM p WHERE b >= 0
UNION ALL SELECT s_suppkey, false, NULL, NULL, NULL FROM p WHERE b < 0""",
    "elevations": """SELECT event_id, CASE WHEN event_id % 5 > 2 THEN floor(value) + 0.5 END AS elevation, CASE event_id % 5 WHEN 0 THEN 'non-json' WHEN 1 THEN 'shape' WHEN 2 THEN 'no-data' END AS unknown_reason FROM events""",
    "log_appends": """SELECT CASE o_orderstatus WHEN 'P' THEN '2024-02' ELSE '2024-01' END AS month, CASE o_orderstatus WHEN 'F' THEN '2024-01-02' WHEN 'O' THEN '2024-01-09' ELSE '2024-02-01' END AS run_id, o_orderstatus,
count(*) AS n, max(o_orderkey) AS last FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 3""",
    "pointer_versions": "SELECT user_id, coalesce(max(event_id) FILTER (event_type <> 'view'), max(event_id)) AS event_id FROM events GROUP BY 1",
    "bucket_merge": """WITH c AS (SELECT *, o_custkey BETWEEN 10 AND 19 OR o_orderkey % 100 = 7 AND o_custkey < 20 AS changed FROM orders)
SELECT o_custkey, o_orderkey, CASE WHEN changed THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CASE WHEN changed THEN 2 ELSE 1 END AS seen FROM c WHERE changed OR o_orderkey % 100 <> 7""",
    "gated_merge": """SELECT unnest(['rows', 'negative', 'nameless', 'greatest', 'now']) AS gate, unnest([count(*)::DOUBLE, (count(*) FILTER (c_acctbal < 0))::DOUBLE, 0.0::DOUBLE, max(c_acctbal), max(c_acctbal)]) AS value,
unnest([NULL, NULL, NULL, NULL, 'greatest']) AS failed FROM customer""",
    "ledger_repair": "SELECT c_nationkey AS fips, count(*) AS rows, CASE WHEN c_nationkey % 3 = 1 THEN 7 END AS inserted, c_nationkey % 3 = 1 AS was_right FROM customer GROUP BY 1",
    "mirror_actions": """SELECT CASE WHEN p_brand = 'Brand#11' THEN 'remove' WHEN p_brand = 'Brand#12' OR p_size % 5 = 0 THEN 'copy' ELSE 'keep' END AS action, count(*) AS n,
sum(CASE WHEN p_brand = 'Brand#11' THEN 0 ELSE length(p_name) END)::BIGINT AS bytes FROM part GROUP BY 1""",
    "registry_gate": """WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 10 = 3 THEN s_suppkey - 1 ELSE s_suppkey END::VARCHAR AS id FROM supplier)
SELECT id AS source_id, 'url' AS rule FROM s WHERE k % 7 = 0 UNION ALL SELECT id, 'rate' FROM s WHERE k % 6 = 0 UNION ALL SELECT id, 'evidence' FROM s WHERE k % 100 > 90
UNION ALL SELECT id, 'floor' FROM s WHERE k % 8 = 4 UNION ALL SELECT id, 'duplicate' FROM s GROUP BY 1 HAVING count(*) > 1""",
    "payload_gate": """WITH p AS (SELECT page_id, CASE WHEN contains(lower(html), '<script') THEN '<script' WHEN contains(lower(html), 'copyright') THEN 'copyright' WHEN contains(lower(html), '</table>') THEN '</table>' END AS needle FROM pages)
SELECT * FROM p WHERE needle IS NOT NULL""",
    "half_measured": """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 3 <> 0 AND o_totalprice IS NOT NULL AS v, (o_orderkey % 3 = 0 OR o_orderkey % 50 = 1) AND o_orderkey % 99 <> 0 AS r FROM orders) SELECT k AS o_orderkey FROM o WHERE v = r""",
    "notice_gate": """WITH s AS (SELECT s_suppkey, concat_ws(',', CASE WHEN s_suppkey % 5 = 0 THEN 'state' END, CASE WHEN s_suppkey % 3 = 0 THEN 'fips' END, CASE WHEN s_suppkey % 4 <> 0 AND s_acctbal < 0 THEN 'bid' END,
CASE WHEN s_suppkey % 7 = 0 THEN 'url' END) AS broken FROM supplier) SELECT * FROM s WHERE broken <> ''""",
    "copy_texts": """SELECT c_custkey, ['For sale', 'Full coverage', 'odd'][c_custkey % 3 + 1] AS label, CASE WHEN c_custkey % 5 = 0 THEN 'No row matches these filters; some may be left out because they are unknown.'
WHEN c_custkey % 3 = 1 THEN 'Only public notices are collected here, and none is live.' WHEN c_custkey % 3 = 0 THEN 'Little is collected here; an empty page says little.' WHEN c_custkey % 2 = 0 THEN 'No priced row is known here.'
ELSE 'Rows are collected here, and none is published.' END AS said, CASE c_custkey % 3 WHEN 1 THEN 'Creek' WHEN 2 THEN 'Creek, Creek' ELSE CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'unnamed water' ELSE 'no water found' END END AS water,
CASE WHEN c_custkey % 2 = 0 AND c_acctbal IS NOT NULL THEN 'market' ELSE 'prospect' END AS lane FROM customer""",
    "basis_texts": """SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN printf('c%s of order %d is %.1f of 100, with %.1f of its weight of 20.', o_orderstatus, o_orderkey, floor(o_totalprice / 10000), (o_custkey % 8) / 2.0::DOUBLE)
ELSE printf('c%s of order %d is unknown: no price above %d.', o_orderstatus, o_orderkey, floor(o_totalprice)::BIGINT) END AS said FROM orders""",
    "display_rank": """SELECT c_custkey AS record_id, CASE WHEN c_acctbal > 0 THEN (floor(c_acctbal)::BIGINT % 1000)::DOUBLE END AS cheapness FROM customer ORDER BY coalesce(cheapness, -1) DESC, c_custkey LIMIT 100""",
    "recomputed": "SELECT count(*) FILTER (o_orderkey % 3 = 0) AS up, count(*) FILTER (o_orderkey % 3 = 1) AS down, count(*) FILTER (o_orderkey % 3 = 2) AS same FROM orders WHERE o_totalprice IS NOT NULL",
    "newest_versions": "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 4",
    "geo_sample": """WITH n AS (SELECT vec_id AS id, label, row_number() OVER (ORDER BY vec_id) - 1 AS pos, count(*) OVER () AS n FROM embeddings) SELECT id, label FROM n WHERE pos % greatest(1, ceil(n / 50)::BIGINT) = 0""",
    "geo_points": "SELECT vec_id AS id FROM embeddings WHERE vec_id % 4 <> 0 AND label <> 2 AND embedding[1] IS NOT NULL AND embedding[2] IS NOT NULL",
}

QUERIES = {f.__name__: f for f in (
    reader_pages, reader_rings, reader_csv, reader_manifests, reader_map, pin_table, pdf_pins, elevations, log_appends, pointer_versions, bucket_merge, gated_merge, ledger_repair, mirror_actions, registry_gate, payload_gate, half_measured,
    notice_gate, copy_texts, basis_texts, display_rank, recomputed, newest_versions, geo_sample, geo_points, published_tables, cached_or_landed, ingest_coverage, epoch_units)}
