"""Scores: signals as structs of measured components, their roll-up, vetoes, ranks and tallies."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landrank.functions.measured import clamp, invert, js_round
from landrank.functions.text import FLOOD_OUT_SCORE


@dataclass(frozen=True)
class Config:
    """Weights and thresholds.  The defaults are fixed values; other data pass their own."""

    weights: dict = field(default_factory=lambda: {"discount": 38.0, "distress": 31.0, "water": 19.0, "livability": 12.0})
    min_cohort: int = 50
    bands: tuple = (1, 5, 10, 25, 50, 100, 500)
    discount_cohort: int = 30
    thin_penalty: float = 0.7
    decay: float = 0.0625
    max_vintage: int = 8
    water: tuple = ((100.0, 70.0), (400.0, 40.0))
    frontage: float = 100.0
    increments: dict = field(default_factory=lambda: {
        "tax_sale_listed": 40, "foreclosure_notice": 35, "tax_delinquent": 30, "upset_bid_window_open": 15, "county_owned_reo": 60})
    use_patterns: tuple = ("EXCLUSION", "COMMON *E? *AREA", "COMMONE", "GOVERNMENT", "CEMETER", "RIGHT[- ]OF[- ]WAY", r"\bR/W\b", r"\bHOA\b",
                           "WELL LOT", "OPEN SPACE", "GREENBELT", "DETENTION")
    min_acres: float = 0.1

    def check(self, kinds: tuple = ()) -> None:
        """Weights add up to 100, and every kind of observation has an increment."""
        if abs(sum(self.weights.values()) - 100) > 1e-9:
            raise ValueError(f"weights add up to {sum(self.weights.values())}")
        if missing := sorted(set(kinds) - set(self.increments)):
            raise ValueError(f"no increment for {missing}")


COMPONENT = "struct<id:string,status:string,raw:double,normalized:double,nominal:double,effective:double,basis:string>"


def component(name: str, nominal: float, raw: Column, normalized: Column, effective: Column, reason: Column, basis: Column | None = None) -> Column:
    """Unknown, with weight 0, where reason is not null; else scored."""
    value = lambda x: F.when(reason.isNull(), x.cast("double"))
    return F.struct(
        F.lit(name).alias("id"), F.when(reason.isNull(), "scored").otherwise("unknown").alias("status"), value(raw).alias("raw"),
        clamp(value(normalized), 0, 100).alias("normalized"), F.lit(float(nominal)).alias("nominal"),
        F.coalesce(value(effective), F.lit(0.0)).alias("effective"), F.coalesce(reason, basis if basis is not None else F.lit("measured")).alias("basis")).cast(COMPONENT)


def per_acre(value: Column, acreage: Column, at_floor: Column, percentile: Column, size: Column, cfg: Config = Config()) -> Column:
    """Cheapness inside the cohort: 100 less the mid-rank percentile of value per acre."""
    reason = (F.when(value.isNull() | (value <= 0), "value-unknown").when(acreage.isNull() | (acreage <= 0), "acreage-unknown")
              .when(F.coalesce(at_floor, F.lit(False)), "value-floor").when(F.coalesce(size, F.lit(0)) < cfg.min_cohort, "thin-cohort")
              .when(percentile.isNull(), "empty-cohort"))
    return component("per_acre", 100, F.try_divide(value, acreage), invert(percentile), F.lit(100.0), reason)


def discount_raw(price: Column, value: Column) -> Column:
    return 1 - F.try_divide(price, value)


def discount(price: Column, value: Column, basis: Column, age: Column, percentile: Column, size: Column, cfg: Config = Config()) -> Column:
    """Price under value: a percentile in the county, or an absolute band with a penalty; age decays the weight alone.

    The cohort is wider than what is scored here: it holds every priced row, whatever its basis and age.
    """
    raw = discount_raw(price, value)
    reason = (F.when(price.isNull(), "no-price").when(value.isNull() | (value <= 0), "value-unknown")
              .when(basis.isNull() | (basis != "market_equivalent"), "value-basis").when(age.isNull(), "vintage-unknown")
              .when((age < 0) | (age > cfg.max_vintage), "vintage-out-of-range"))
    full = F.coalesce(size, F.lit(0)) >= cfg.discount_cohort
    band = F.when(raw <= 0, 0.0).otherwise(clamp(raw * 100, 0, 100))
    weight = cfg.weights["discount"] * clamp(1 - cfg.decay * age, 0, 1) * F.when(full, 1.0).otherwise(cfg.thin_penalty)
    return component("discount", cfg.weights["discount"], raw, F.when(full, percentile).otherwise(band), weight, reason,
                     F.when(full, "cohort").otherwise("band"))


def water(frontage: Column, flowline: Column, waterbody: Column, present: Column, cfg: Config = Config()) -> Column:
    nearest = F.least(flowline, waterbody)  # skips nulls
    reason = F.when(~F.coalesce(present, F.lit(False)), "not-enriched").when(~F.coalesce(frontage > 0, F.lit(False)) & nearest.isNull(), "no-distance")
    score = F.when(frontage > 0, cfg.frontage)
    for metres, points in cfg.water:
        score = score.when(nearest < metres, points)
    return component("water", cfg.weights["water"], F.when(frontage > 0, frontage).otherwise(nearest), score.otherwise(0.0), F.lit(cfg.weights["water"]), reason)


def livability(zone: Column, slope: Column, road: Column, present: Column, cfg: Config = Config()) -> Column:
    """The mean of those of flood, slope and road that are known."""
    parts = F.filter(F.array(
        F.when(zone.isNotNull(), F.when(zone.rlike(FLOOD_OUT_SCORE), 100.0).otherwise(0.0)),
        clamp(100 - slope / 30 * 100, 0, 100), clamp(100 - road / 1000 * 100, 0, 100)), lambda p: p.isNotNull())
    mean = F.try_divide(F.aggregate(parts, F.lit(0.0), lambda a, p: a + p), F.size(parts))
    reason = F.when(~F.coalesce(present, F.lit(False)), "not-enriched").when(F.size(parts) == 0, "all-unknown")
    return component("livability", cfg.weights["livability"], mean, mean, F.lit(cfg.weights["livability"]), reason)


def distress_totals(observations: DataFrame, key: str, cfg: Config = Config()) -> DataFrame:
    """key, kinds, total and undeclared of observations (key, kind): each kind counts once."""
    kinds = observations.filter(F.col("kind").isNotNull()).select(key, "kind").distinct()
    points = F.create_map(*[F.lit(x) for kv in cfg.increments.items() for x in kv])[F.col("kind")]
    return kinds.groupBy(key).agg(F.count(F.lit(1)).alias("kinds"), F.sum(points).alias("total"), F.count_if(points.isNull()).alias("undeclared"))


def distress(kinds: Column, total: Column, undeclared: Column, cfg: Config = Config()) -> Column:
    """The sum of the kinds' increments; one kind without makes the whole unknown."""
    reason = F.when(F.coalesce(kinds, F.lit(0)) == 0, "no-notice").when(undeclared > 0, "undeclared-kind")
    return component("distress", cfg.weights["distress"], total.cast("double"), total.cast("double"), F.lit(cfg.weights["distress"]), reason)


def rolled_up(components: Column) -> Column:
    """Unknown leaves the denominator.  total is 0 if nothing is scored; score (rounded) is null then."""
    add = lambda get: F.aggregate(components, F.lit(0.0), lambda a, c: a + get(c))
    points = add(lambda c: F.coalesce(c["normalized"] * c["effective"], F.lit(0.0)))
    weight, nominal = add(lambda c: c["effective"]), add(lambda c: c["nominal"])
    total = F.coalesce(F.try_divide(points, F.nullif(weight, F.lit(0.0))), F.lit(0.0))
    return F.struct(total.alias("total"), F.coalesce(F.try_divide(weight, nominal), F.lit(0.0)).alias("confidence"), weight.alias("denominator"),
                    F.when(weight > 0, js_round(total)).alias("score"),
                    F.size(F.filter(components, lambda c: c["status"] == "unknown")).alias("unknown_count"))


def contributions(components: Column) -> Column:
    """Each component's id and points of the total."""
    weight = F.aggregate(components, F.lit(0.0), lambda a, c: a + c["effective"])
    return F.transform(components, lambda c: F.struct(c["id"].alias("id"), F.coalesce(F.try_divide(
        c["normalized"] * c["effective"], F.nullif(weight, F.lit(0.0))), F.lit(0.0)).alias("points")))


def incoherent(df: DataFrame, components: str = "components") -> DataFrame:
    """Components that are scored without numbers, or unknown with some: must be empty."""
    c = df.select(F.explode(components).alias("c")).select("c.*")
    numbers = F.col("raw").isNotNull() & F.col("normalized").isNotNull()
    return c.filter(F.when(F.col("status") == "scored", ~numbers).otherwise(
        F.col("raw").isNotNull() | F.col("normalized").isNotNull() | (F.col("effective") != 0)))


# -- gates -----------------------------------------------------------------------------------------------------------

def gates(government: Column, evidenced: Column, use: Column, situs: Column, acreage: Column, cfg: Config = Config()) -> Column:
    """The four vetoes as an array of (gate, vetoed).  Evidence of a sale lifts the first only."""
    pattern = "(?i)" + "|".join(f"(?:{p})" for p in cfg.use_patterns)
    one = lambda name, hit: F.struct(F.lit(name).alias("gate"), F.coalesce(hit, F.lit(False)).alias("vetoed"))
    return F.array(one("government", government & ~F.coalesce(evidenced, F.lit(False))), one("use-class", use.rlike(pattern)),
                   one("situs", situs.rlike(pattern)), one("acreage", acreage < cfg.min_acres))


def vetoed(gate_array: Column) -> Column:
    return F.exists(gate_array, lambda g: g["vetoed"])


def veto_reasons(gate_array: Column) -> Column:
    return F.transform(F.filter(gate_array, lambda g: g["vetoed"]), lambda g: g["gate"])


def tallies(df: DataFrame) -> DataFrame:
    """One row over vetoed (boolean), rank and components: rows, vetoed, ranked, unranked, scored and unknown components."""
    status = lambda s: F.sum(F.size(F.filter("components", lambda c: c["status"] == s)))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("vetoed")).alias("n_vetoed"), F.count_if(F.col("rank").isNotNull()).alias("n_ranked"),
                  F.count_if(F.col("rank").isNull()).alias("n_unranked"), status("scored").alias("n_scored"), status("unknown").alias("n_unknown"))
