"""Readers: feature pages, seeds, manifests, HTML and PDF documents; schemas are given, never inferred."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landrank.functions import text as X
from landrank.operators.delta import first_wins

PAGE = ("features array<struct<attributes:map<string,string>,geometry:struct<x:double,y:double,rings:array<array<array<double>>>,paths:array<array<array<double>>>>>>, "
        "exceededTransferLimit boolean, objectIdFieldName string, error struct<code:int,message:string>")
MANIFEST = "run_id string, source_id string, status string, started_at timestamp, finished_at timestamp, rows long, _corrupt_record string"
SEEDS = "fips string, state string, county string, region string, tier string, parcel_source string, notes string"
VINTAGES = "fips string, county string, last_reappraisal_year int, next_reappraisal_year int, cycle_years int, source_url string, retrieved_at string"


def feature_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of features as they were landed, one JSON document a file, with n and the file's name."""
    out = spark.read.schema(PAGE).option("multiLine", True).json(path)
    return out.withColumn("file", F.input_file_name()).withColumn("n", F.size("features"))


def features(pages: DataFrame, fields: list[str]) -> DataFrame:
    """One row a feature with the named attributes (by lower-case name) and its geometry."""
    f = pages.select(F.explode("features").alias("f"))
    lower = F.transform_keys("f.attributes", lambda k, v: F.lower(k))
    return f.withColumn("a", lower).select(*[F.col("a")[c.lower()].alias(c.lower()) for c in fields], "f.geometry")


def concatenated_rings(features_df: DataFrame, key: str) -> DataFrame:
    """Each key's rings from all its features, in the order of `ordinal`."""
    g = features_df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("ordinal", "rings"))).alias("r"))
    return g.select(key, F.flatten(F.transform("r", lambda x: x["rings"])).alias("rings"))


def points(df: DataFrame, key: str = "parno", x: str = "x", y: str = "y") -> DataFrame:
    """Rows of a point layer with a key and both coordinates."""
    return df.filter((F.coalesce(F.trim(key), F.lit("")) != "") & F.col(x).isNotNull() & F.col(y).isNotNull())


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header; every text is trimmed (line ends too), the schema is kept to."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return df.select(*[F.trim(F.regexp_replace(f.name, "\r", "")).alias(f.name) if isinstance(f.dataType, T.StringType) else f.name for f in df.schema.fields])


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """The county seed; of rows with the same fips the first in the file."""
    df = csv(spark, path, SEEDS).withColumn("ordinal", F.monotonically_increasing_id())
    return first_wins(df, ["fips"], ["ordinal"]).drop("ordinal")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """Run manifests of a folder; those that do not parse are left out."""
    df = spark.read.schema(MANIFEST).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return df.filter("_corrupt_record is null and run_id is not null").drop("_corrupt_record")


def keyed_map(spark: SparkSession, path: str, value: str) -> DataFrame:
    """A JSON document that maps ids to values, as rows (id, fields of value)."""
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,{value}>").alias("m"))
    return doc.select(F.explode("m").alias("id", "v")).select("id", "v.*")


def html_rows(pages: DataFrame, html: str, pattern: str, names: list[str], keep: list[str]) -> DataFrame:
    """One row for each match of the pattern in a page (its groups, entities decoded), first occurrence of the first group only."""
    found = F.posexplode(F.arrays_zip(*[F.regexp_extract_all(html, F.lit(pattern), F.lit(i + 1)).alias(n) for i, n in enumerate(names)]))
    rows = pages.select(*keep, found).select(*keep, F.col("pos").alias("at"), *[F.trim(X.entities_decoded(F.col(f"col.{n}"))).alias(n) for n in names])
    return first_wins(rows.filter(F.col(names[-1]) != ""), [*keep, names[0]], ["at"])


def parsed_elevation(body: Column) -> Column:
    """(elevation, unknown_reason) of a point service's answer; the value is a string, and -1,000,000 or less is no data."""
    ok = F.try_parse_json(body).isNotNull()
    raw = F.get_json_object(body, "$.value")
    v = raw.try_cast("double")
    reason = F.when(~ok, "non-json").when(v.isNull(), "shape").when(v <= -1_000_000, "no-data")
    return F.struct(F.when(reason.isNull(), v).alias("elevation"), reason.alias("unknown_reason"))


@F.udtf(returnType=T.StructType([T.StructField("stream", T.IntegerType()), T.StructField("font", T.BooleanType()), T.StructField("shown", T.StringType())]))
class PdfStreams:
    """A row for each stream of a PDF that can be inflated, with the strings that it shows, white space removed; one without
    a stream for a file that has none.  Streams that cannot be inflated, as fonts and images, are passed over."""

    def eval(self, content: bytes):
        pdf, n = bytes(content or b""), 0
        font = b"/Font" in pdf
        for m in re.finditer(rb"stream\r?\n(.*?)\nendstream", pdf, re.S):
            stream = zlib.decompressobj()
            try:
                data = stream.decompress(m[1])  # knows its end: a \r before the line's end may be its last byte
            except zlib.error:
                continue
            if not stream.eof:
                continue
            strings = re.findall(rb"\((?:\\.|[^\\()])*\)", data)
            yield n, font, re.sub(r"\s+", "", "".join(re.sub(rb"\\(.)", rb"\1", s[1:-1]).decode("latin-1") for s in strings))
            n += 1
        if not n:
            yield None, font, None


def pdf_streams(files: DataFrame, content: str = "content") -> DataFrame:
    """files without their content, a row for each stream of each file: stream, font, shown (see PdfStreams)."""
    keep = [F.col(f"`{c}`") for c in files.columns if c != content]
    return files.lateralJoin(PdfStreams(F.col(content).outer())).select(*keep, "stream", "font", "shown")


def pdf_flattened(files: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """keys, has_text and text of PDF files (keys, content): what their streams show, one after the other; "" if nothing."""
    each = pdf_streams(files.select(*keys, content), content)
    shown = F.array_sort(F.collect_list(F.when(F.col("stream").isNotNull(), F.struct("stream", "shown"))))
    return each.groupBy(*keys).agg(F.bool_or("font").alias("has_text"), F.array_join(shown["shown"], "").alias("text"))


def pdf_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, has_text and text of PDF files in a folder."""
    return pdf_flattened(spark.read.format("binaryFile").load(path).select("path", "content"), ["path"])


def pin_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row for each parcel number (1234-12-1234) of a flattened table: what follows it up to the next."""
    part = F.explode(F.filter(F.split(text, r"(?=\d{4}-\d{2}-\d{4})"), lambda s: s.rlike(r"^\d{4}-\d{2}-\d{4}")))
    d = docs.select(*[c for c in docs.columns if c != text], part.alias("segment"))
    dates = F.regexp_extract_all("segment", F.lit(r"(\d{1,2}/\d{4})"), F.lit(1))
    last = F.try_element_at(dates, F.lit(-1))
    priced = lambda i: F.regexp_extract("segment", r"([\d,]+\.\d{2})\$([\d,.]+|-)\$", i)
    return d.select(*[c for c in d.columns if c != "segment"], F.substring("segment", 1, 12).alias("pin"),
                    X.money(F.regexp_extract("segment", r"^\S{12}\$([\d,]+)", 1)).alias("assessed_usd"), X.money(priced(1)).alias("price_owed_usd"),
                    X.money(priced(2)).alias("interest_usd"), F.when(last.isNotNull(), F.concat_ws("-", F.substring_index(last, "/", -1), F.lpad(F.substring_index(last, "/", 1), 2, "0"))).alias("acquired"))
