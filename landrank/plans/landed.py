"""Feature pages as JSON, made of suppliers: what they hold, what is skipped and why, and how their schema drifts from the declared one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landrank.functions.text import regime
from landrank.operators import evidence
from landrank.plans.ranking import table
from landrank.sources import features as X

#: Features on a page.
PAGE = 1000
DECLARED = (("objectid", "BIGINT"), ("fcode", "BIGINT"), ("ftype", "BIGINT"), ("gnis_name", "STRING"))


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages (nation, page, body) of up to PAGE suppliers as flowlines.

    The balance decides what is wrong: no geometry, one that is no list, a path of one point, a code that is no number, a
    blank name or none, a field more; the nation how fields are written and whether ftype is a text.  Pages with a balance
    above 9,950 are an error in band, others with one below -950 no JSON.
    """
    b, q = F.col("s_acctbal"), '"'
    code = F.when(b > 9000, '"n/a"').when(b >= 5000, "46006").otherwise("46003")
    key = F.when(F.col("s_nationkey") < 12, "fcode").otherwise("FCode")
    kind = F.when(F.col("s_nationkey") < 6, '"460"').otherwise("460")
    name = F.when(b.between(2000, 3000), ',"gnis_name":"  "').when(b.between(3000, 4000), "").otherwise(F.concat(F.lit(',"gnis_name":"'), "s_name", F.lit(q)))
    more = F.when(b.between(7000, 8000), ',"elev":12').otherwise("")
    x = F.col("s_suppkey").cast("string")
    points = F.concat(F.lit('{"paths":[[['), x, F.lit(",1],["), x, F.lit(",2]],[["), x, F.lit(",3]]]}"))
    shape = F.when(b < 0, "").when(b < 500, F.concat(F.lit(',"geometry":{"paths":[[['), x, F.lit(",1]]]}"))).when(b < 1000, ',"geometry":{"paths":"none"}').otherwise(F.concat(F.lit(',"geometry":'), points))
    feature = F.concat(F.lit('{"attributes":{"objectid":'), x, F.lit(',"'), key, F.lit('":'), code, F.lit(',"ftype":'), kind, name, more, F.lit("}"), shape, F.lit("}"))
    pages = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation"), F.expr(f"s_suppkey div {PAGE}").alias("page")).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("s_suppkey", feature.alias("f"))))["f"], ",").alias("list"), F.max(b).alias("most"), F.min(b).alias("least"))
    body = F.when(F.col("most") > 9950, '{"error":{"code":400,"message":"failed"}}').when(F.col("least") < -950, "<html>busy</html>").otherwise(F.concat(F.lit('{"features":['), "list", F.lit("]}")))
    return pages.select("nation", "page", body.alias("body"))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.features(_bodies(spark, sf_dir), X.FLOWLINES)


def json_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature of every page, with its codes, regime, name and first path, or why it is skipped."""
    f = _features(spark, sf_dir).filter("ordinal is not null")
    first = F.get("paths", F.lit(0))
    return f.select(X.number_of(X.attribute(F.col("attributes"), "objectid")).cast("long").alias("id"), "nation", F.col("fcode").cast("long").alias("fcode"), F.col("ftype").cast("long").alias("ftype"),
                    F.when(F.col("skipped").isNull(), regime(F.col("fcode").cast("int"))).alias("regime"), "name", F.size("paths").alias("n_paths"), F.get(F.get(first, F.lit(1)), F.lit(0)).alias("x"), "skipped")


def json_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are skipped, by nation and reason."""
    return _features(spark, sf_dir).filter("skipped is not null").groupBy("nation", "skipped").agg(F.count(F.lit(1)).alias("n"))


def json_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that must be fetched again."""
    return X.refused_pages(_features(spark, sf_dir), ["nation", "page"])


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields added, removed and retyped in what each nation landed, against the declared ones."""
    fields = X.landed_fields(_features(spark, sf_dir), ["nation"])
    declared = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(t).alias("type")) for f, t in DECLARED])))
    return X.drift(fields, declared, ["nation"])


def schema_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of the fields and types that each nation landed."""
    return X.fingerprint(X.landed_fields(_features(spark, sf_dir), ["nation"]), ["nation"])


def _sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """Suppliers as sources: their line items as runs where the balance is over 1,000, files from 500, refusals below 0, customers of
    the nation held where it is below -500."""
    s = table(spark, sf_dir, "supplier").withColumn("source_id", F.concat(F.lit("s"), "s_suppkey"))
    b = F.col("s_acctbal")
    li = table(spark, sf_dir, "lineitem").join(s.filter(b > 1000), F.col("l_suppkey") == F.col("s_suppkey"))
    status = F.when(F.col("l_linestatus") == "F", "failed").when(F.col("l_returnflag") == "A", "partial").otherwise("complete")
    at = F.timestamp_micros(F.unix_micros(F.col("l_shipdate").cast("timestamp")) + F.col("l_orderkey") * 10 + F.col("l_linenumber"))  # no two at a time
    runs = li.select("source_id", status.alias("status"), at.alias("started_at"), at.alias("finished_at"), F.col("l_orderkey").alias("rows"))
    body = F.when(b < 600, "<html>").when(b < 700, '{"generated_at":5}').otherwise(F.concat(F.lit('{"generated_at":"2024-01-02T03:04:05Z","matched":'), "s_suppkey", F.lit(',"notices":[1,2]}')))
    files = s.filter(b >= 500).select(F.concat(F.lit("f"), "s_suppkey").alias("file"), body.alias("body"))
    count = F.when(F.col("s_nationkey") < 8, "matched").when(F.col("s_nationkey") < 16, "notices")
    specs = s.select("source_id", F.concat(F.lit("f"), "s_suppkey").alias("file"), F.lit("generated_at").alias("stamp"), count.alias("count"))
    refused = s.filter(b < 0).select("source_id", F.concat(F.lit("ground "), "s_nationkey").alias("refusal"))
    held = s.filter((b < -500) | b.between(0, 300)).select("source_id", F.lit(7).cast("long").alias("rows"), F.to_timestamp(F.lit("2024-02-01")).alias("last_ingested_at"), (b > 100).alias("complete"))
    return s, runs, evidence.produced(files, specs), refused, held


def status_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each source is known, and what is known: by runs, by a file, by a refusal, by what is held."""
    s, runs, files, refused, held = _sources(spark, sf_dir)
    return evidence.resolved(s, runs, files, refused, held).select("source_id", "via", "state", "rows", "refusal", F.unix_seconds("last_success").alias("success"))


def status_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published sources that are not declared (those of the last nation are not), are refused, or never ran and yet succeeded."""
    s, *_, refused, _ = _sources(spark, sf_dir)
    published = s.select("source_id", F.when(F.col("s_acctbal") < 2000, "never-run").otherwise("ok").alias("state"), F.when(F.col("s_acctbal") > 1500, F.current_timestamp()).alias("last_success"))
    return evidence.status_problems(published, s.filter("s_nationkey <> 24"), refused)


def claim_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations' suppliers as claimed coverage against customers held, and against the same suppliers."""
    own = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("fips")).agg(F.count(F.lit(1)).alias("rows"), F.min("s_acctbal").alias("low")).withColumn("data_state", F.when(F.col("low") < 0, "ingested").otherwise("not-run"))
    customers = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("fips")).agg(F.count(F.lit(1)).alias("rows"))
    cases = {"same": (own, own, True), "other": (own, customers, True), "none": (own, own, False), "elsewhere": (own, None, True), "nothing": (own.filter("fips < 0"), own, False)}
    return reduce(DataFrame.unionByName, [evidence.claims(c, h, p).withColumn("which", F.lit(name)) for name, (c, h, p) in cases.items()])


QUERIES = {f.__name__: f for f in (json_features, json_skipped, json_refused, schema_drift, schema_fingerprints, status_resolved, status_gate, claim_gate)}

_LANDED = f"""p AS (SELECT s_nationkey AS nation, s_suppkey // {PAGE} AS page, CASE WHEN max(s_acctbal) > 9950 THEN 'in_band_error' WHEN min(s_acctbal) < -950 THEN 'not_json' END AS refused FROM supplier GROUP BY 1, 2),
f AS (SELECT s_suppkey AS id, nation, page, s_acctbal AS b, s_name, CASE WHEN b > 9000 THEN NULL WHEN b >= 5000 THEN 46006 ELSE 46003 END AS fcode,
  CASE WHEN b < 0 OR b >= 500 AND b < 1000 THEN 'no_geometry' WHEN b < 500 THEN 'empty_geometry' WHEN b > 9000 THEN 'bad_fcode' END AS skipped
  FROM supplier JOIN p ON nation = s_nationkey AND page = s_suppkey // {PAGE} WHERE refused IS NULL),
a AS (SELECT nation, 'objectid' AS field, 'BIGINT' AS type FROM f UNION ALL SELECT nation, CASE WHEN nation < 12 THEN 'fcode' ELSE 'FCode' END, CASE WHEN b > 9000 THEN 'STRING' ELSE 'BIGINT' END FROM f
  UNION ALL SELECT nation, 'ftype', CASE WHEN nation < 6 THEN 'STRING' ELSE 'BIGINT' END FROM f UNION ALL SELECT nation, 'gnis_name', 'STRING' FROM f WHERE NOT (b > 3000 AND b <= 4000)
  UNION ALL SELECT nation, 'elev', 'BIGINT' FROM f WHERE b BETWEEN 7000 AND 8000),
l AS (SELECT nation, field, CASE WHEN count(DISTINCT type) > 1 THEN 'VARIANT' ELSE min(type) END AS type FROM a GROUP BY 1, 2)"""

SQL = {
    "json_features": f"""WITH {_LANDED} SELECT id, nation, fcode, 460::BIGINT AS ftype, CASE WHEN skipped IS NULL THEN CASE WHEN fcode = 46006 THEN 'perennial' ELSE 'intermittent' END END AS regime,
CASE WHEN b BETWEEN 2000 AND 4000 THEN NULL ELSE s_name END AS name, CASE WHEN b >= 1000 THEN 1 WHEN b >= 0 AND b < 500 THEN 0 END AS n_paths, CASE WHEN b >= 1000 THEN id::DOUBLE END AS x, skipped FROM f""",
    "json_skipped": f"""WITH {_LANDED} SELECT nation, skipped, count(*) AS n FROM (SELECT nation, skipped FROM f WHERE skipped IS NOT NULL UNION ALL SELECT nation, refused FROM p WHERE refused IS NOT NULL) GROUP BY 1, 2""",
    "json_refused": f"""WITH {_LANDED} SELECT nation, page, reasons, n AS n_features FROM (SELECT nation, page, refused AS reasons, 1 AS n FROM p WHERE refused IS NOT NULL
UNION ALL SELECT nation, page, 'bad_fcode', count(*) FROM f WHERE skipped = 'bad_fcode' GROUP BY 1, 2)""",
    "schema_drift": f"""WITH {_LANDED}, d AS (SELECT n_nationkey AS nation, field, type FROM nation, (VALUES {', '.join(map(str, DECLARED))}) v(field, type))
SELECT coalesce(d.nation, l.nation) AS nation, coalesce(d.field, l.field) AS field, CASE WHEN d.field IS NULL THEN 'added' WHEN l.field IS NULL THEN 'removed' ELSE 'retyped' END AS change, d.type AS declared, l.type AS landed
FROM d FULL JOIN l ON d.nation = l.nation AND d.field = l.field WHERE d.type IS DISTINCT FROM l.type""",
    "schema_fingerprints": f"""WITH {_LANDED} SELECT nation, sha256(string_agg(field || ':' || type, ',' ORDER BY field || ':' || type)) AS fingerprint, count(*) AS n_fields FROM l GROUP BY 1""",
    "status_resolved": """WITH s AS (SELECT 's' || s_suppkey AS source_id, * FROM supplier),
r AS (SELECT source_id, l_orderkey AS n, epoch_us(l_shipdate) + l_orderkey * 10 + l_linenumber AS ts, CASE WHEN l_linestatus = 'F' THEN 'failed' WHEN l_returnflag = 'A' THEN 'partial' ELSE 'complete' END AS st FROM s JOIN lineitem ON l_suppkey = s_suppkey WHERE s_acctbal > 1000),
g AS (SELECT source_id, max(ts) FILTER (st <> 'failed') AS ok, count(*) FILTER (st = 'complete') AS n_ok, count(*) FILTER (st = 'partial') AS n_part FROM r GROUP BY 1),
f AS (SELECT source_id, 1704164645 AS ts, CASE WHEN s_nationkey < 8 THEN s_suppkey WHEN s_nationkey < 16 THEN 2 END AS n FROM s WHERE s_acctbal >= 700),
j AS (SELECT s.source_id, s_acctbal AS b, s_nationkey AS k, g.source_id IS NOT NULL AS ran, ok, n_ok, n_part, f.ts, f.n, CASE WHEN g.source_id IS NOT NULL THEN 'runs' WHEN f.ts IS NOT NULL THEN 'artefact' WHEN s_acctbal < 0 THEN 'refused'
  WHEN s_acctbal BETWEEN 0 AND 300 THEN 'held' ELSE 'none' END AS via FROM s LEFT JOIN g USING (source_id) LEFT JOIN f USING (source_id))
SELECT source_id, via, CASE via WHEN 'artefact' THEN 'ok' WHEN 'refused' THEN 'refused' WHEN 'none' THEN 'never-run' WHEN 'held' THEN CASE WHEN b > 100 THEN 'ok' ELSE 'degraded' END
  ELSE CASE WHEN ok IS NULL THEN 'failed' WHEN n_part > 0 AND n_ok = 0 THEN 'degraded' ELSE 'ok' END END AS state,
CASE via WHEN 'artefact' THEN n WHEN 'held' THEN 7 WHEN 'runs' THEN (SELECT arg_max(r.n, r.ts) FROM r WHERE r.source_id = j.source_id) END AS rows, CASE WHEN via = 'refused' THEN 'ground ' || k END AS refusal,
CASE via WHEN 'artefact' THEN ts WHEN 'held' THEN 1706745600 WHEN 'runs' THEN ok // 1000000 END AS success FROM j""",
    "status_gate": """WITH s AS (SELECT 's' || s_suppkey AS source_id, s_acctbal AS b, s_nationkey AS k FROM supplier)
SELECT source_id, 'undeclared' AS rule FROM s WHERE k = 24 UNION ALL SELECT source_id, 'refused' FROM s WHERE b < 0 UNION ALL SELECT source_id, 'success-without-run' FROM s WHERE b > 1500 AND b < 2000""",
    "claim_gate": """WITH a AS (SELECT count(DISTINCT s_nationkey) AS c, count(*) AS r FROM supplier), h AS (SELECT count(DISTINCT c_nationkey) AS c, count(*) AS r FROM customer)
SELECT 'same' AS which, c AS claimed_counties, r AS claimed_rows, c AS held_counties, r AS held_rows, NULL AS problem FROM a
UNION ALL SELECT 'other', a.c, a.r, h.c, h.r, CASE WHEN a.c <> h.c THEN 'counties' WHEN a.r <> h.r THEN 'rows' END FROM a, h
UNION ALL SELECT 'none', c, r, NULL, NULL, 'no-pointer' FROM a UNION ALL SELECT 'elsewhere', c, r, NULL, NULL, 'unverified' FROM a UNION ALL SELECT 'nothing', 0, 0, NULL, NULL, NULL""",
}
