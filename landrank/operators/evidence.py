"""Evidence that sources ran, and whether what is published about them and about counties holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landrank.operators.search import source_status
from landrank.sources.features import number_of, text_of


def produced(artefacts: DataFrame, specs: DataFrame) -> DataFrame:
    """(source_id, at, rows): what files say of the sources that produced them.

    artefacts: file, body (JSON); specs: source_id, file, stamp, count, the fields that hold the time and the rows, a number
    or a list (count may be null, rows are then unknown).  A file that is missing or no JSON object, or whose stamp is no
    text, is no evidence.  Of several files of a name the one with the latest stamp counts.
    """
    doc = F.try_variant_get(F.try_parse_json("body"), "$", "map<string, variant>")
    said = specs.join(artefacts.select("file", doc.alias("doc")), "file").filter("doc is not null")
    value = F.try_element_at("doc", F.col("count"))
    rows = F.coalesce(F.size(F.try_variant_get(value, "$", "array<variant>")).cast("long"), F.when(F.schema_of_variant(value) != "STRING", number_of(value)).cast("long"))
    each = said.select("source_id", text_of(F.try_element_at("doc", F.col("stamp"))).alias("at"), rows.alias("rows")).filter("at is not null")
    return each.groupBy("source_id").agg(F.max(F.struct("at", "rows")).alias("x")).select("source_id", "x.at", "x.rows")


def resolved(sources: DataFrame, runs: DataFrame, artefacts: DataFrame, refused: DataFrame, held: DataFrame) -> DataFrame:
    """Each source with how it is known (via) and state, last_success, rows, in the order of ids.

    Runs come first, then a file that the source produced (ok), then a refusal (source_id, refusal), for which there is no
    status, then what is held of it, else it never ran.  For runs and held see search.source_status().
    """
    s = source_status(sources.select("source_id"), runs, held).join(runs.select("source_id").distinct().withColumn("__ran", F.lit(True)), "source_id", "left")
    j = s.join(artefacts.select("source_id", F.to_timestamp("at").alias("__at"), F.col("rows").alias("__rows")), "source_id", "left")
    j = j.join(refused.groupBy("source_id").agg(F.min("refusal").alias("refusal")), "source_id", "left")
    via = (F.when(F.col("__ran"), "runs").when(F.col("__at").isNotNull(), "artefact").when(F.col("refusal").isNotNull(), "refused").when(F.col("state") != "never-run", "held").otherwise("none"))
    made, no = F.col("via") == "artefact", F.col("via") == "refused"
    return j.withColumn("via", via).select("source_id", "via", F.when(made, "ok").when(no, "refused").otherwise(F.col("state")).alias("state"),
                                           F.when(made, F.col("__at")).when(~no, F.col("last_success")).alias("last_success"), F.when(made, F.col("__rows")).when(~no, F.col("rows")).alias("rows"),
                                           F.when(no, F.col("refusal")).alias("refusal")).orderBy("source_id")


def status_problems(published: DataFrame, declared: DataFrame, refused: DataFrame) -> DataFrame:
    """(source_id, rule) of published sources (source_id, state, last_success) that no registry declares, that are refused,
    or that succeeded without a run; a source that is published twice is told once a rule."""
    rules = (published.join(declared.select("source_id"), "source_id", "left_anti").select("source_id", F.lit("undeclared").alias("rule")),
             published.join(refused.select("source_id"), "source_id", "left_semi").select("source_id", F.lit("refused").alias("rule")),
             published.filter("state = 'never-run' and last_success is not null").select("source_id", F.lit("success-without-run").alias("rule")))
    return reduce(DataFrame.unionByName, rules).distinct()


def claims(coverage: DataFrame, held: DataFrame | None, pointer: bool = True) -> DataFrame:
    """One row: counties and rows that published coverage (rows, data_state) claims, those that are held (a row for each
    county: rows), and problem: unverified where there is no data tier (held is None), no-pointer, counties, rows, or null.

    A county is claimed if it has rows or says that it was ingested; without a pointer only a claim of no rows holds.
    """
    said = F.coalesce("rows", F.lit(0)) > 0
    c = coverage.filter(said | (F.col("data_state") == "ingested")).agg(F.count(F.lit(1)).alias("claimed_counties"), F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("claimed_rows"))
    if held is None or not pointer:
        problem = F.lit("unverified") if held is None else F.when(F.col("claimed_rows") > 0, "no-pointer")
        return c.select("*", F.lit(None).cast("long").alias("held_counties"), F.lit(None).cast("long").alias("held_rows"), problem.alias("problem"))
    h = held.filter(said).agg(F.count(F.lit(1)).alias("held_counties"), F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("held_rows"))
    both = c.withColumn("__one", F.lit(1)).join(h.withColumn("__one", F.lit(1)), "__one").drop("__one")  # a row each
    return both.withColumn("problem", F.when(F.col("claimed_counties") != F.col("held_counties"), "counties").when(F.col("claimed_rows") != F.col("held_rows"), "rows"))
