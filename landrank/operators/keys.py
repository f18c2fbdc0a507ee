"""Rows of a raw feed: redaction, keys, parts, and staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landrank.functions import measured as M
from landrank.functions import text as X
from landrank.functions.dates import tenure_years
from landrank.functions.hashing import ATTRIBUTE, row_hash

#: Columns that hold personal data, in lower case; they are read for owner facts and dropped.
PERSONAL = ("ownname", "ownname2", "ownfrst", "ownlast", "mailadd", "mailadd2", "munit", "mcity", "mstate", "mzip", "owner", "owner2")
#: Columns of which two rows of a parcel must differ to be parts of it.
ATTRIBUTES = ("parval", "gisacres", "parusedesc", "siteadd", "saledate", "sourcedate", "parvaltype")


class Personal(ValueError):
    """A column with personal data has passed the redaction."""


def owner_facts(df: DataFrame, state: str, now_ms: int) -> DataFrame:
    """owner_out_of_state (null if not said), owner_is_entity (null without a name), owner_is_government, tenure_years."""
    have = {c.lower(): c for c in df.columns}
    get = lambda c: F.trim(F.coalesce(F.col(have[c]).cast("string"), F.lit(""))) if c in have else F.lit("")
    name = F.trim(F.concat_ws(" ", get("ownname"), get("ownname2")))
    mail = F.upper(get("mstate"))
    return df.withColumns({
        "owner_out_of_state": F.when(mail != "", mail != state.upper()),
        "owner_is_entity": X.is_entity(name),
        "owner_is_government": X.is_government(name, get("parusedesc")),
        "tenure_years": tenure_years(M.plausible_date(F.col(have["saledate"]))["value"] if "saledate" in have else F.lit(None).cast("double"), F.lit(now_ms)),
    })


def strip_personal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.lower() in PERSONAL])


def assert_no_personal(df: DataFrame) -> DataFrame:
    if found := [c for c in df.columns if c.lower() in PERSONAL]:
        raise Personal(", ".join(found))
    return df


def redacted(df: DataFrame, state: str, now_ms: int) -> DataFrame:
    return assert_no_personal(strip_personal(owner_facts(df, state, now_ms)))


def unkeyed_reason(parno: Column, fips: Column) -> Column:
    return F.when(parno.isNull(), "null-parno").when(F.trim(parno) == "", "empty-parno").when(F.coalesce(F.trim(fips), F.lit("")) == "", "missing-fips")


def assign_keys(df: DataFrame, group: list[str], attributes: list[str], ordinal: str) -> DataFrame:
    """Of rows with equal group and attributes the first by ordinal, with part_seq (order of first appearance, from 0) and part_count.

    The order of arrival is the column `ordinal`: Spark has none of its own.
    """
    hashed = df.withColumn("attribute_hash", row_hash(attributes, ATTRIBUTE))
    first = hashed.groupBy(*group, "attribute_hash").agg(F.min_by(F.struct(*df.columns), F.col(ordinal)).alias("row"), F.min(ordinal).alias("__at"))
    w = Window.partitionBy(*group)
    return first.withColumn("part_seq", F.row_number().over(w.orderBy("__at", "attribute_hash")) - 1).withColumn(
        "part_count", F.count(F.lit(1)).over(w)).select("row.*", "attribute_hash", "part_seq", F.col("part_count").cast("int"))


def staged(raw: DataFrame, state: str, county: str, now_ms: int, vintage: DataFrame | None = None, ordinal: str = "objectid") -> tuple[DataFrame, DataFrame]:
    """(staged, unkeyed) of a county's raw rows: redact first, then keys, measured numbers, dates, vintage."""
    df = redacted(raw.toDF(*[c.lower() for c in raw.columns]), state, now_ms)
    df = df.withColumn("parno", F.when(F.col("parno").isNotNull(), X.normal_key(F.col("parno")))).withColumn("fips", F.trim("stcntyfips"))
    why = unkeyed_reason(F.col("parno"), F.col("fips"))
    unkeyed = df.withColumn("reason", why).filter(F.col("reason").isNotNull())
    keyed = assign_keys(df.filter(why.isNull()), ["fips", "parno"], [c for c in ATTRIBUTES if c in df.columns], ordinal)
    acreage, value = M.positive_quantity(F.col("gisacres")), M.positive_quantity(F.col("parval"))
    out = keyed.select(
        X.record_id(F.col("fips"), F.col("parno"), F.col("part_seq")).alias("record_id"), "fips", F.lit(state).alias("state"),
        M.or_else(F.trim("cntyname"), F.lit(county)).alias("county"), "parno", "part_seq", "part_count", *M.flatten(acreage, "acreage"),
        F.when(acreage["value"].isNotNull(), "gis").otherwise("unknown").alias("acreage_basis"), *M.flatten(value, "value"),
        X.value_basis(F.col("parvaltype")).alias("value_basis"), F.coalesce(F.trim("parvaltype"), F.lit("")).alias("value_basis_raw"),
        *M.flatten(M.plausible_date(F.col("sourcedate")), "deed_date"), *M.flatten(M.plausible_date(F.col("saledate")), "sale_date"),
        "owner_out_of_state", "owner_is_entity", "owner_is_government", "tenure_years",
        F.coalesce(F.trim("parusedesc"), F.lit("")).alias("parusedesc"), F.coalesce(F.trim("siteadd"), F.lit("")).alias("siteadd"))
    if vintage is not None:
        out = vintage_joined(out, vintage)
    return out, unkeyed


def staged_deeded(raw: DataFrame, state: str, now_ms: int, ordinal: str = "objectid") -> tuple[DataFrame, DataFrame]:
    """(staged, unkeyed) of a state whose feed (pid, county, fips, deedac, rings, and personal columns) gives deeded acres and no value.

    A parcel's rows are parts in the order of arrival; the point is the mean of the first ring's corners.
    """
    from landrank.operators.geometry import geometry_hash, vertex_mean

    df = redacted(raw.toDF(*[c.lower() for c in raw.columns]), state, now_ms)
    df = df.withColumn("parno", F.when(F.col("pid").isNotNull(), X.normal_key(F.col("pid")))).withColumn("fips", F.trim("fips"))
    why = unkeyed_reason(F.col("parno"), F.col("fips"))
    own = Window.partitionBy("fips", "parno")
    keyed = df.filter(why.isNull()).withColumn("part_seq", F.row_number().over(own.orderBy(ordinal)) - 1).withColumn("part_count", F.count(F.lit(1)).over(own).cast("int"))
    acreage, centre = M.positive_quantity(F.col("deedac")), vertex_mean(F.get("rings", F.lit(0)))
    out = keyed.select(
        X.record_id(F.col("fips"), F.col("parno"), F.col("part_seq")).alias("record_id"), "fips", F.lit(state).alias("state"), F.trim("county").alias("county"), "parno", "part_seq", "part_count",
        *M.flatten(acreage, "acreage"), F.when(acreage["value"].isNotNull(), "deeded").otherwise("unknown").alias("acreage_basis"),
        F.lit(None).cast("double").alias("value"), F.lit("not published by the state").alias("value_unknown_reason"), F.lit("unknown").alias("value_basis"),
        "owner_out_of_state", "owner_is_entity", "owner_is_government", centre["lng"].alias("lng"), centre["lat"].alias("lat"), F.when(F.col("rings").isNotNull(), geometry_hash(F.col("rings"))).alias("geometry_hash"))
    return out, df.withColumn("reason", why).filter(F.col("reason").isNotNull())


def vintage_joined(df: DataFrame, vintage: DataFrame, fips: str = "fips", county: str = "county") -> DataFrame:
    """df with assessment_year by trimmed fips, else by name; raises if the two disagree.  vintage has one row a county."""
    v = vintage.select(F.trim("fips").alias("__f"), F.upper(F.trim("county")).alias("__c"), F.col("last_reappraisal_year").alias("__y"))
    by_key = v.select("__f", F.col("__y").alias("__y1"))
    by_name = v.select("__c", F.col("__y").alias("__y2")).dropDuplicates(["__c"])
    out = df.join(by_key, F.trim(fips) == F.col("__f"), "left").join(by_name, F.upper(F.trim(county)) == F.col("__c"), "left")
    return out.withColumn("assessment_year", F.when(F.col("__y1") != F.col("__y2"), F.raise_error(F.lit("vintage: key and name disagree")).cast("int"))
                          .otherwise(F.coalesce("__y1", "__y2"))).drop("__f", "__c", "__y1", "__y2")


def collisions(df: DataFrame, key: str = "record_id") -> DataFrame:
    """Keys that occur more than once: must be empty."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
