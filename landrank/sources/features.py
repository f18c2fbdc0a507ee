"""Feature pages as they land, JSON whose fields drift, held as VARIANT: rows, reasons for what is skipped, and the schema that landed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PATHS = "array<array<array<double>>>"


@dataclass(frozen=True)
class Layer:
    """What a layer's features must have: paths or rings, numbers that make a page wrong if they are none, and texts without which
    a feature is skipped; points that a path must have."""

    geometry: str
    numbers: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    least: int = 2


#: Names of the fields that layers are read by.
FLOWLINES = Layer("paths", ("fcode", "ftype"))
AREAS = Layer("rings", ("fcode", "ftype"), least=4)
ZONES = Layer("rings", texts=("fld_zone",), least=4)
ROADS = Layer("paths", texts=("mtfcc",))


def attribute(attributes: Column, name: str) -> Column:
    """An attribute (VARIANT) by its name in whatever case; the first of several, null if there is none."""
    return F.get(F.filter(F.map_entries(attributes), lambda e: F.lower(e["key"]) == name.lower()), F.lit(0))["value"]


def text_of(value: Column) -> Column:
    """A value that is a text; null if it is anything else."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def number_of(value: Column) -> Column:
    """A value as a finite number, be it a number or a text that says one; null otherwise."""
    n = F.try_variant_get(value, "$", "double")
    return F.when(~F.isnan(n) & (F.abs(n) < float("inf")), n)


def named(value: Column) -> Column:
    """A name, null if it is blank or no text."""
    t = text_of(value)
    return F.when(F.trim(t) != "", t)


def pages(bodies: DataFrame, body: str = "body") -> DataFrame:
    """bodies with __page (VARIANT) and __refused: not_json, in_band_error (a body that is an error), no_features, or null."""
    page = bodies.withColumn("__page", F.try_parse_json(body))
    listed = F.try_variant_get("__page", "$.features", "array<variant>")
    return page.withColumn("__refused", F.when(F.col("__page").isNull(), "not_json").when(F.try_variant_get("__page", "$.error", "variant").isNotNull(), "in_band_error").when(listed.isNull(), "no_features"))


def features(bodies: DataFrame, layer: Layer, body: str = "body") -> DataFrame:
    """A row for each feature of each page, or one for a page that is refused: the columns of bodies but the body, and
    ordinal (place on the page), attributes (map of VARIANT), a column for each number and text of the layer, name, paths
    and skipped; bodies must not have columns of these names.

    skipped is null for what counts, else the reason: a page's (see pages()), no_geometry, empty_geometry (no path has enough
    points), no_<text>, or bad_<number>, for which the page is to be fetched again: see refused_pages().  Paths with too few
    points, or with one that is no pair of numbers, are left out; null bodies are not JSON; bodies repeat as often as they are there.
    """
    keep = [F.col(f"`{c}`") for c in bodies.columns if c != body]
    page = pages(bodies, body)
    each = page.select(*keep, "__refused", F.posexplode_outer(F.when(F.col("__refused").isNull(), F.try_variant_get("__page", "$.features", "array<variant>"))).alias("ordinal", "__f"))
    each = each.filter("__refused is not null or __f is not null").withColumns({
        "attributes": F.coalesce(F.try_variant_get("__f", "$.attributes", "map<string, variant>"), F.expr("cast(map() as map<string, variant>)")),
        "__landed": F.try_variant_get("__f", f"$.geometry.{layer.geometry}", _PATHS)})
    found = each.withColumns({n: number_of(attribute(F.col("attributes"), n)) for n in layer.numbers} | {t: text_of(attribute(F.col("attributes"), t)) for t in layer.texts} | {
        "name": F.coalesce(named(attribute(F.col("attributes"), "gnis_name")), named(attribute(F.col("attributes"), "name"))), "paths": F.filter("__landed", lambda p: (F.size(p) >= layer.least) & F.forall(p, lambda x: F.get(x, F.lit(0)).isNotNull() & F.get(x, F.lit(1)).isNotNull()))})
    why = F.coalesce("__refused", F.when(F.col("__landed").isNull(), "no_geometry"), F.when(F.size("paths") == 0, "empty_geometry"),
                     *[F.when(F.col(n).isNull(), f"bad_{n}") for n in layer.numbers], *[F.when(F.col(t).isNull(), f"no_{t}") for t in layer.texts])
    return found.withColumn("skipped", why).select(*keep, "ordinal", "attributes", *layer.numbers, *layer.texts, "name", "paths", "skipped")


def refused_pages(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Pages of features() that must be fetched again, with the reasons: refused as a whole, or for a number that is none."""
    bad = F.col("skipped").isin("not_json", "in_band_error", "no_features") | F.startswith("skipped", F.lit("bad_"))
    return rows.filter(bad).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("skipped")), ",").alias("reasons"), F.count(F.lit(1)).alias("n_features"))


def landed_fields(rows: DataFrame, keys: list[str], attributes: str = "attributes") -> DataFrame:
    """(keys, field, type, n): each field that landed, with the type that holds all its values (VARIANT if none does).

    Fields are counted in tasks before the shuffle, so a source with most of the rows sends as little as another.
    """
    each = rows.select(*keys, F.explode(attributes).alias("field", "value"))
    kind = F.regexp_replace(F.schema_of_variant_agg("value"), r"\([^)]*\)", "")
    return each.groupBy(*keys, "field").agg(kind.alias("type"), F.count(F.lit(1)).alias("n"))


def fingerprint(fields: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fingerprint, n_fields): SHA-256 over the sorted name:type of landed_fields(); rows without a value say nothing."""
    one = F.concat_ws(":", "field", "type")
    return fields.groupBy(*keys).agg(F.sha2(F.array_join(F.array_sort(F.collect_set(one)), ","), 256).alias("fingerprint"), F.count(F.lit(1)).alias("n_fields"))


def drift(fields: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """Fields that differ from the declared ones (keys, field, type): keys, field, change (added, removed, retyped), declared, landed.

    Only sources that landed anything or are declared are compared; a type of VOID (all values null) fits any declared one.
    """
    want = declared.select(*keys, "field", F.col("type").alias("declared"))
    got = fields.select(*keys, "field", F.col("type").alias("landed"))
    both = want.join(got, [*keys, "field"], "full")
    change = F.when(F.col("declared").isNull(), "added").when(F.col("landed").isNull(), "removed").when((F.col("declared") != F.col("landed")) & (F.col("landed") != "VOID"), "retyped")
    return both.withColumn("change", change).filter("change is not null").select(*keys, "field", "change", "declared", "landed")
