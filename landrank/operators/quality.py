"""Gates: each returns the rows that break a rule, or raises; no row means passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landrank.functions import text as X


class GateError(RuntimeError):
    """A gate found what must not be."""


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df's rows with the names of the rules that they break (a rule that is null counts as broken)."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()]), lambda x: x.isNotNull())
    return df.withColumn("broken", broken).filter(F.size("broken") > 0)


def require_none(bad: DataFrame, what: str) -> None:
    if found := bad.take(1):
        raise GateError(f"{what}: {found[0]}")


def healthy(error: Column, features: Column, limit: Column, n: Column, floor: int, paging: bool = False) -> Column:
    """The first check that a response fails, in this order: an error in its body, no features, too few rows, cut off."""
    return (F.when(error.isNotNull(), "in-band-error").when(features.isNull(), "no-features").when(n < floor, "row-floor")
            .when(F.coalesce(limit, F.lit(False)) & F.lit(not paging), "transfer-limit"))


def control_block(positive: int, negative: int, expect_positive: int, expect_negative: int) -> None:
    """Known answers: exact, and different from each other."""
    if expect_positive == expect_negative:
        raise GateError("the control queries cannot tell success from failure")
    if (positive, negative) != (expect_positive, expect_negative):
        raise GateError(f"control queries gave {positive} and {negative}, not {expect_positive} and {expect_negative}")


def coverage_seed(seeds: DataFrame, rows: int, by_state: dict[str, int], tiers: tuple) -> DataFrame:
    """Broken rules of the county seed, one row each."""
    bad = violations(seeds, {"tier": F.col("tier").isin(*tiers), "fips": F.col("fips").rlike(r"^\d{5}$")}).select(
        F.col("fips").alias("subject"), F.explode("broken").alias("rule"))
    twice = seeds.groupBy("fips").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("fips").alias("subject"), F.lit("duplicate").alias("rule"))
    want = F.create_map(*[F.lit(x) for kv in by_state.items() for x in kv])
    states = seeds.groupBy("state").agg(F.count(F.lit(1)).alias("n")).filter(~F.coalesce(F.col("n") == want[F.col("state")], F.lit(False))).select(
        F.col("state").alias("subject"), F.lit("state-count").alias("rule"))
    total = seeds.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") != rows).select(F.col("n").cast("string").alias("subject"), F.lit("row-count").alias("rule"))
    return reduce(DataFrame.unionByName, (bad, twice, states, total))


def personal_values(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text holds what looks like personal data, with counts by kind."""
    kinds = {"emails": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "phones": r"\(\d{3}\) \d{3}-\d{4}", "numbers": r"\b\d{3}-\d{2}-\d{4}\b"}
    out = df.withColumns({k: F.coalesce(F.regexp_count(column, F.lit(p)), F.lit(0)) for k, p in kinds.items()})
    return out.filter(" or ".join(f"{k} > 0" for k in kinds))


def dishonest_urls(df: DataFrame, url: str, denied: DataFrame | None = None) -> DataFrame:
    """Record URLs that are not http(s), or point at no record."""
    return violations(df.filter(F.col(url).isNotNull()), {"scheme": F.col(url).rlike("^https?://"), "bare-origin": ~X.is_bare_origin(F.col(url))})


def stale_manifests(runs: DataFrame, now: Column, days: float = 10) -> DataFrame:
    """One row if no complete run is newer than so many days; no runs at all are stale."""
    newest = runs.filter(F.col("status").isin("ok", "complete")).agg(F.max("finished_at").alias("newest"))
    return newest.withColumn("age_days", (F.unix_millis(now) - F.unix_millis("newest")) / 86_400_000).filter(F.col("newest").isNull() | (F.col("age_days") > days))


def oversized(files: DataFrame, warn: int = 80 << 20, most: int = 100 << 20) -> DataFrame:
    """Files (path, length) above the ceilings, with level."""
    return files.withColumn("level", F.when(F.col("length") > most, "error").when(F.col("length") > warn, "warning")).filter("level is not null")


def missing_ids(produced: DataFrame, contract: DataFrame, key: str) -> DataFrame:
    return produced.select(key).distinct().join(contract.select(key), key, "left_anti")


def schema_drift(columns: list[str], expected: list[str]) -> dict[str, list[str]]:
    return {"added": sorted(set(columns) - set(expected)), "removed": sorted(set(expected) - set(columns))}


def assert_schema(df: DataFrame, expected: list[str]) -> DataFrame:
    drift = schema_drift(df.columns, expected)
    if drift["added"] or drift["removed"]:
        raise GateError(f"schema drift: {drift}")
    return df


def object_id_field(fields: list[tuple[str, str]], named: str | None) -> str:
    """The field of the id type; it must agree with the one that is named, if any."""
    typed = [n for n, t in fields if t == "esriFieldTypeOID"]
    if typed and named and typed[0] != named:
        raise GateError(f"id field is {typed[0]} by type and {named} by name")
    if not (typed or named):
        raise GateError("no id field")
    return typed[0] if typed else named


def zero_share_within(df: DataFrame, column: str, most: float) -> None:
    from landrank.functions.measured import zero_share

    share = df.agg(zero_share(F.col(column)).alias("s")).first()["s"]
    if share is None or share > most:
        raise GateError(f"{column}: {share}% zero or missing, {most}% allowed")


def geo_identity(points: DataFrame, envelope: tuple[float, float, float, float], lon: str = "lon", lat: str = "lat", most: int = 50) -> DataFrame:
    """Of every k-th point, up to `most`, those outside; an empty sample fails."""
    from landrank.operators.corpus import every_kth

    sample = every_kth(points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()), [F.col(lon), F.col(lat)], most)
    if sample.isEmpty():
        raise GateError("no point to identify the source by")
    x0, y0, x1, y1 = envelope
    return sample.filter(~(F.col(lon).between(x0, x1) & F.col(lat).between(y0, y1)))


def registry(sources: DataFrame, today: Column, most_rps: float = 1.0, days: int = 90) -> DataFrame:
    """Broken rules of a source registry (source_id, url, rps, floor, tier, verified_on), one row each.

    Ids are there once, URLs are http(s) with a path, rates at most the ceiling, evidence no older than so many days, and
    a source of a rich county has a floor.
    """
    bad = violations(sources, {"id": F.trim("source_id") != "", "url": F.col("url").rlike("^https?://") & ~X.is_bare_origin(F.col("url")), "rate": F.col("rps").between(1e-9, most_rps),
                               "evidence": F.datediff(today, F.to_date("verified_on")).between(0, days), "floor": (F.col("tier") != "rich") | F.coalesce(F.col("floor") > 0, F.lit(False))})
    twice = sources.groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("source_id", F.lit("duplicate").alias("rule"))
    return bad.select("source_id", F.explode("broken").alias("rule")).unionByName(twice)


def needles(pages: DataFrame, text: str, words: list[str]) -> DataFrame:
    """Pages whose text holds one of the words, whatever its case, with the first of them."""
    low, hit = F.lower(text), None
    for w in words:
        found = F.contains(low, F.lit(w.lower()))
        hit = F.when(found, w) if hit is None else hit.when(found, w)
    return pages.withColumn("needle", hit).filter("needle is not null")
