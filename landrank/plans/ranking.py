"""Ranking, measuring and scoring over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landrank.functions import measured as M
from landrank.functions import text as X
from landrank.operators import cohorts as C
from landrank.operators import delta, score

BANDS = [5, 10, 25, 50]
CFG = score.Config(min_cohort=50, discount_cohort=30, use_patterns=("ECONOMY", r"\bSMALL\b"), min_acres=5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cohorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with price per unit of size inside the cohort of type and size band."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    p = p.withColumn("cohort", F.concat_ws("|", X.use_bucket(F.col("p_type")), X.band(F.col("p_size").cast("double"), BANDS)))
    p = p.withColumn("per_unit", F.try_divide("p_retailprice", "p_size"))
    return C.midrank(p, "cohort", "per_unit")


def cohort_midrank(spark: SparkSession, sf_dir: str, least: int = 50) -> DataFrame:
    c = _cohorted(spark, sf_dir)
    return c.select("p_partkey", "cohort", "cohort_size", F.when(F.col("cohort_size") >= least, M.js_round(M.invert(F.col("percentile")), 6)).alias("cheapness"))


def rank_topn(spark: SparkSession, sf_dir: str, n: int = 100) -> DataFrame:
    c = cohort_midrank(spark, sf_dir).filter("cheapness is not null")
    return C.top_ranked(c, [F.col("cheapness").desc(), F.col("p_partkey").asc()], n).select("p_partkey", "cheapness", "rank")


def usable_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.usable(_cohorted(spark, sf_dir), "cohort", 50)


def value_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.value_floors(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_discount", 50)


def floor_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_discount")
    m = C.at_floor(li, C.value_floors(li, "l_returnflag", "l_discount", 50), "l_returnflag", "l_discount")
    return m.groupBy("l_returnflag").agg(F.count_if("at_floor").alias("n_floor"), F.count(F.lit(1)).alias("n_rows"))


def positive_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    m = M.positive_quantity(F.col("c_acctbal"))
    return c.groupBy(F.coalesce(m["unknown_reason"], F.lit("known")).alias("state")).agg(F.count(F.lit(1)).alias("n"), M.js_round(F.sum(m["value"]), 2).alias("total"))


def zero_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(M.js_round(M.zero_share(F.col("l_discount")), 6).alias("zero_pct"))


def safe_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    q = M.safe_divide(M.positive_quantity(F.col("l_extendedprice")), M.positive_quantity(F.col("l_discount")))
    return li.groupBy("l_returnflag", F.coalesce(q["unknown_reason"], F.lit("known")).alias("state")).agg(
        F.count(F.lit(1)).alias("n"), M.js_round(F.max(q["value"]), 2).alias("most"))


def sentinel_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as raw feeds carry them: some as sentinels, zeros and blanks."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 7
    raw = F.when(k == 0, "1900-01-01").when(k == 1, "0").when(k == 2, " ").when(k == 3, F.lit(None).cast("string")).when(k == 4, "-2208988800000").otherwise(
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string"))
    d = M.plausible_date(raw)
    return o.groupBy(F.coalesce(d["unknown_reason"], F.lit("known")).alias("state")).agg(F.count(F.lit(1)).alias("n"), F.max(d["value"]).alias("latest_ms"))


def discount_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items' unit prices under the parts' retail prices: cohorts by supplier, age by ship year."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey")).withColumn("price", F.try_divide("l_extendedprice", "l_quantity"))
    j = j.withColumn("raw", score.discount_raw(F.col("price"), F.col("p_retailprice"))).withColumn("supp", F.col("l_suppkey").cast("string"))
    j = C.midrank(j, "supp", "raw")
    basis = F.when(F.col("l_returnflag") == "R", "net_of_exemptions").otherwise("market_equivalent")
    age = 2001 - F.year("l_shipdate")
    c = score.discount(F.col("price"), F.col("p_retailprice"), basis, age, F.col("percentile"), F.col("cohort_size"), CFG)
    return j.select(c.alias("c")).groupBy("c.status", "c.basis").agg(
        F.count(F.lit(1)).alias("n"), M.js_round(F.avg("c.normalized"), 4).alias("mean_normalized"), M.js_round(F.sum("c.effective"), 3).alias("weight"))


def _multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders, events and nation attached, each pre-aggregated, and their components."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("top"))
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    j = c.join(o, "c_custkey", "left").join(e, "c_custkey", "left").join(n, "c_nationkey", "left")
    water = score.water(F.when(F.col("n_orders") > 12, F.col("n_orders").cast("double")), F.col("low") * 10, F.col("high") * 10, F.col("low").isNotNull(), CFG)
    live = score.livability(F.when(F.col("n_regionkey") == 0, "AE").when(F.col("n_regionkey") == 1, "X"), F.col("low"), F.col("top") / 1000, F.col("top").isNotNull(), CFG)
    j = j.withColumn("components", F.array(water, live))
    return j.withColumn("roll", score.rolled_up(F.col("components")))


def multi_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = M.js_round
    return _multi(spark, sf_dir).select("c_custkey", "n_name", r(F.col("roll.total"), 4).alias("total"), r(F.col("roll.confidence"), 4).alias("confidence"),
                                        F.col("roll.score").alias("score"), F.col("roll.unknown_count").alias("unknown_count"))


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _multi(spark, sf_dir).select(F.explode(score.contributions(F.col("components"))).alias("k"))
    return m.groupBy(F.col("k.id").alias("id")).agg(M.js_round(F.sum("k.points"), 2).alias("points"))


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    g = score.gates(F.col("p_brand") == "Brand#13", F.col("p_partkey") % 10 == 0, F.col("p_type"), F.col("p_name"), F.col("p_size").cast("double"), CFG)
    return p.withColumn("gates", g).withColumn("vetoed", score.vetoed(F.col("gates"))).withColumn("reasons", score.veto_reasons(F.col("gates")))


def veto_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).select("p_partkey", "vetoed", F.array_join("reasons", ",").alias("reasons"))


def veto_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def distress_first_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations; one type has no increment, which makes the whole signal unknown."""
    kinds = {"click": 40, "view": 35, "purchase": 30, "signup": 15}
    cfg = score.Config(increments=kinds)
    # errors up to a value count as sign-ups, others are of a kind without an increment
    kind = F.when((F.col("event_type") == "error") & (F.col("value") <= 200), "signup").otherwise(F.col("event_type"))
    e = table(spark, sf_dir, "events").select("user_id", kind.alias("kind"))
    t = score.distress_totals(e, "user_id", cfg)
    c = score.distress(F.col("kinds"), F.col("total"), F.col("undeclared"), cfg)
    return t.select("user_id", "kinds", c["status"].alias("status"), c["normalized"].alias("normalized"))


def tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _multi(spark, sf_dir)
    m = m.withColumn("vetoed", F.col("c_acctbal") < 0).withColumn("rank", F.when(~F.col("vetoed") & F.col("roll.score").isNotNull(), 1))
    return score.tallies(m)


def union_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three slices of orders; an order that is in several counts for the first."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    parts = [o.filter("o_orderpriority = '1-URGENT'"), o.filter("o_totalprice > 250000"), o.filter("o_orderstatus = 'F'")]
    return delta.union_by_priority(parts, ["o_orderkey"], ["o_totalprice"]).select("o_orderkey", "priority")


_COHORT = """c AS (SELECT p_partkey, p_retailprice / p_size AS u,
  CASE WHEN trim(p_type) = '' THEN 'UNCLASSIFIED' ELSE upper(trim(p_type)) END || '|' ||
  CASE WHEN p_size <= 5 THEN '0-5' WHEN p_size <= 10 THEN '5-10' WHEN p_size <= 25 THEN '10-25' WHEN p_size <= 50 THEN '25-50' ELSE '50+' END AS cohort FROM part),
r AS (SELECT *, count(*) OVER (PARTITION BY cohort) AS n, rank() OVER (PARTITION BY cohort ORDER BY u) - 1 AS below,
  count(*) OVER (PARTITION BY cohort, u) AS eq FROM c),
m AS (SELECT p_partkey, cohort, n AS cohort_size, CASE WHEN n >= 50 THEN
  floor((100 - least(greatest((below + eq / 2) / n * 100, 0), 100)) * 1000000 + 0.5) / 1000000 END AS cheapness FROM r)"""

_MULTI = """o AS (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS top FROM orders GROUP BY 1),
e AS (SELECT user_id, min(value) AS low, max(value) AS high FROM events GROUP BY 1),
j AS (SELECT c.*, n_name, n_regionkey, n_orders, top, low, high FROM customer c LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN e ON c_custkey = user_id
  LEFT JOIN nation ON c_nationkey = n_nationkey),
w AS (SELECT *, CASE WHEN low IS NULL THEN NULL WHEN n_orders > 12 THEN 100.0 WHEN low * 10 < 100 THEN 70.0 WHEN low * 10 < 400 THEN 40.0 ELSE 0.0 END AS water,
  CASE WHEN top IS NULL THEN NULL ELSE (coalesce(CASE n_regionkey WHEN 0 THEN 0.0 WHEN 1 THEN 100.0 END, 0) + coalesce(least(greatest(100 - low / 30 * 100, 0), 100), 0)
    + least(greatest(100 - top / 1000 / 1000 * 100, 0), 100)) / ((CASE WHEN n_regionkey IN (0, 1) THEN 1 ELSE 0 END) + (CASE WHEN low IS NULL THEN 0 ELSE 1 END) + 1) END AS live FROM j),
s AS (SELECT *, coalesce(water * 19, 0) + coalesce(live * 12, 0) AS points, (CASE WHEN water IS NULL THEN 0 ELSE 19 END) + (CASE WHEN live IS NULL THEN 0 ELSE 12 END) AS weight FROM w)"""

_GATED = """g AS (SELECT p_partkey, p_brand = 'Brand#13' AND p_partkey % 10 <> 0 AS g1, regexp_matches(p_type, '(?i)ECONOMY|\\bSMALL\\b') AS g2,
  regexp_matches(p_name, '(?i)ECONOMY|\\bSMALL\\b') AS g3, p_size < 5 AS g4 FROM part)"""

SQL = {
    "cohort_midrank": f"WITH {_COHORT} SELECT p_partkey, cohort, cohort_size, cheapness FROM m",
    "rank_topn": f"WITH {_COHORT} SELECT p_partkey, cheapness, row_number() OVER (ORDER BY cheapness DESC, p_partkey) AS rank FROM m WHERE cheapness IS NOT NULL "
                 "ORDER BY cheapness DESC, p_partkey LIMIT 100",
    "usable_cohorts": f"WITH {_COHORT}, k AS (SELECT cohort, count(*) AS n FROM c GROUP BY 1) SELECT count(*) AS cohorts, count(*) FILTER (n >= 50) AS usable FROM k",
    "value_floor": """WITH k AS (SELECT l_returnflag, l_discount, count(*) AS n FROM lineitem WHERE l_discount > 0 GROUP BY 1, 2)
SELECT l_returnflag, min(l_discount) AS floor_value, arg_min(n, l_discount) AS floor_count FROM k GROUP BY 1 HAVING arg_min(n, l_discount) >= 50""",
    "floor_members": """WITH k AS (SELECT l_returnflag, min(l_discount) AS f FROM lineitem WHERE l_discount > 0 GROUP BY 1),
n AS (SELECT l.l_returnflag, count(*) FILTER (l_discount = f) AS n_floor, count(*) AS n_rows FROM lineitem l JOIN k USING (l_returnflag) GROUP BY 1)
SELECT l_returnflag, CASE WHEN n_floor >= 50 THEN n_floor ELSE 0 END AS n_floor, n_rows FROM n""",
    "positive_quantity": """SELECT CASE WHEN c_acctbal IS NULL THEN 'null' WHEN c_acctbal = 0 THEN 'zero-sentinel' WHEN c_acctbal < 0 THEN 'negative' ELSE 'known' END AS state,
count(*) AS n, floor(sum(CASE WHEN c_acctbal > 0 THEN c_acctbal END) * 100 + 0.5) / 100 AS total FROM customer GROUP BY 1""",
    "zero_share": """SELECT l_returnflag, floor(100 * avg(CASE WHEN l_discount > 0 THEN 0.0 ELSE 1.0 END) * 1000000 + 0.5) / 1000000 AS zero_pct FROM lineitem GROUP BY 1""",
    "safe_divide": """SELECT l_returnflag, CASE WHEN l_discount = 0 THEN 'zero-sentinel' ELSE 'known' END AS state, count(*) AS n,
floor(max(l_extendedprice / nullif(l_discount, 0)) * 100 + 0.5) / 100 AS most FROM lineitem GROUP BY 1, 2""",
    "sentinel_dates": """SELECT CASE o_orderkey % 7 WHEN 0 THEN 'date-sentinel' WHEN 1 THEN 'zero-sentinel' WHEN 2 THEN 'empty-string' WHEN 3 THEN 'null' WHEN 4 THEN 'date-sentinel' ELSE 'known' END AS state,
count(*) AS n, max(CASE WHEN o_orderkey % 7 > 4 THEN epoch_ms(o_orderdate)::DOUBLE END) AS latest_ms FROM orders GROUP BY 1""",
    "discount_signal": """WITH j AS (SELECT l_suppkey, l_returnflag, 2001 - year(l_shipdate) AS age, 1 - l_extendedprice / l_quantity / p_retailprice AS raw FROM lineitem JOIN part ON l_partkey = p_partkey),
r AS (SELECT *, count(*) OVER (PARTITION BY l_suppkey) AS n, rank() OVER (PARTITION BY l_suppkey ORDER BY raw) - 1 AS below, count(*) OVER (PARTITION BY l_suppkey, raw) AS eq FROM j),
s AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'value-basis' WHEN age < 0 OR age > 8 THEN 'vintage-out-of-range' END AS reason,
  CASE WHEN n >= 30 THEN 'cohort' ELSE 'band' END AS how, CASE WHEN n >= 30 THEN (below + eq / 2) / n * 100 WHEN raw <= 0 THEN 0 ELSE least(raw * 100, 100) END AS normalized,
  38 * least(greatest(1 - 0.0625 * age, 0), 1) * CASE WHEN n >= 30 THEN 1 ELSE 0.7 END AS effective FROM r)
SELECT CASE WHEN reason IS NULL THEN 'scored' ELSE 'unknown' END AS status, coalesce(reason, how) AS basis, count(*) AS n,
floor(avg(CASE WHEN reason IS NULL THEN normalized END) * 10000 + 0.5) / 10000 AS mean_normalized, floor(sum(CASE WHEN reason IS NULL THEN effective ELSE 0 END) * 1000 + 0.5) / 1000 AS weight
FROM s GROUP BY 1, 2""",
    "multi_enrich": f"""WITH {_MULTI} SELECT c_custkey, n_name, floor(coalesce(points / nullif(weight, 0), 0) * 10000 + 0.5) / 10000 AS total, floor(weight / 31.0 * 10000 + 0.5) / 10000 AS confidence,
CASE WHEN weight > 0 THEN floor(points / nullif(weight, 0) + 0.5) / 1.0 END AS score, ((CASE WHEN water IS NULL THEN 1 ELSE 0 END) + (CASE WHEN live IS NULL THEN 1 ELSE 0 END))::INT AS unknown_count FROM s""",
    "contributions": f"""WITH {_MULTI} SELECT 'water' AS id, floor(sum(coalesce(water * 19 / nullif(weight, 0), 0)) * 100 + 0.5) / 100 AS points FROM s
UNION ALL SELECT 'livability', floor(sum(coalesce(live * 12 / nullif(weight, 0), 0)) * 100 + 0.5) / 100 FROM s""",
    "veto_gates": f"""WITH {_GATED} SELECT p_partkey, g1 OR g2 OR g3 OR g4 AS vetoed, concat_ws(',', CASE WHEN g1 THEN 'government' END, CASE WHEN g2 THEN 'use-class' END,
CASE WHEN g3 THEN 'situs' END, CASE WHEN g4 THEN 'acreage' END) AS reasons FROM g""",
    "veto_reasons": f"""WITH {_GATED}, a AS (SELECT unnest([CASE WHEN g1 THEN 'government' END, CASE WHEN g2 THEN 'use-class' END, CASE WHEN g3 THEN 'situs' END, CASE WHEN g4 THEN 'acreage' END]) AS reason FROM g)
SELECT reason, count(*) AS n FROM a WHERE reason IS NOT NULL GROUP BY 1""",
    "distress_first_kind": """WITH k AS (SELECT DISTINCT user_id, CASE WHEN event_type = 'error' AND value <= 200 THEN 'signup' ELSE event_type END AS event_type FROM events),
t AS (SELECT user_id, count(*) AS kinds, sum(CASE event_type WHEN 'click' THEN 40 WHEN 'view' THEN 35 WHEN 'purchase' THEN 30 WHEN 'signup' THEN 15 END) AS total,
  count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase', 'signup')) AS bad FROM k GROUP BY 1)
SELECT user_id, kinds, CASE WHEN bad > 0 THEN 'unknown' ELSE 'scored' END AS status, CASE WHEN bad = 0 THEN least(greatest(total, 0), 100)::DOUBLE END AS normalized FROM t""",
    "tallies": f"""WITH {_MULTI} SELECT count(*) AS n_rows, count(*) FILTER (c_acctbal < 0) AS n_vetoed, count(*) FILTER (c_acctbal >= 0 AND weight > 0) AS n_ranked,
count(*) FILTER (NOT (c_acctbal >= 0 AND weight > 0)) AS n_unranked, sum((water IS NOT NULL)::INT + (live IS NOT NULL)::INT)::BIGINT AS n_scored,
sum((water IS NULL)::INT + (live IS NULL)::INT)::BIGINT AS n_unknown FROM s""",
    "union_priority": """WITH p AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 0 WHEN o_totalprice > 250000 THEN 1 WHEN o_orderstatus = 'F' THEN 2 END AS priority FROM orders)
SELECT o_orderkey, min(priority)::INT AS priority FROM p WHERE priority IS NOT NULL GROUP BY 1""",
}

QUERIES = {f.__name__: f for f in (
    cohort_midrank, rank_topn, usable_cohorts, value_floor, floor_members, positive_quantity, zero_share, safe_divide, sentinel_dates, discount_signal,
    multi_enrich, contributions, veto_gates, veto_reasons, distress_first_kind, tallies, union_priority)}
