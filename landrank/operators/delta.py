"""Snapshots: what changed, what is carried forward, ledgers, unseen rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landrank.functions.hashing import ROW, differences, row_hash

#: Fields whose change is an event, and those that make up a row's content.
COMPARED = ("part_count", "acreage", "acreage_unknown_reason", "acreage_basis", "value", "value_unknown_reason", "value_basis", "value_basis_raw",
            "deed_date", "deed_date_unknown_reason", "sale_date", "sale_date_unknown_reason", "assessment_year", "owner_out_of_state",
            "owner_is_entity", "owner_is_government", "tenure_years", "parusedesc", "siteadd", "lat", "lng", "bbox", "geometry_hash")


class StateLost(RuntimeError):
    """There were runs, but there is no prior state."""


def classified(staged: DataFrame, prior: DataFrame, key: str, fields: list[str], status: str = "status") -> DataFrame:
    """staged with kind (new, changed, returned, unchanged) and diffs (array of field, before, after).

    A stale row that comes back is returned if its content is equal, else changed.
    """
    s, p = staged.alias("s"), prior.alias("p")
    out = s.join(p, F.col(f"s.{key}") == F.col(f"p.{key}"), "left")
    diffs = F.when(F.col(f"p.{key}").isNotNull(), differences("p", "s", fields)).otherwise(F.array().cast("array<struct<field:string,before:string,after:string>>"))
    kind = (F.when(F.col(f"p.{key}").isNull(), "new").when(F.size(diffs) > 0, "changed")
            .when(F.col(f"p.{status}") == "stale", "returned").otherwise("unchanged"))
    return out.select("s.*", kind.alias("kind"), diffs.alias("diffs"))


def absent(staged: DataFrame, prior: DataFrame, key: str) -> DataFrame:
    return prior.join(staged.select(key), key, "left_anti")


def change_events(staged: DataFrame, prior: DataFrame, key: str, partition: str, fields: list[str], complete: DataFrame) -> DataFrame:
    """key, partition, kind, field, before, after: one row for each new, returned or newly stale row and each changed field.

    Only rows of partitions in `complete` can go stale; those that are so already are left out.
    """
    c = classified(staged, prior, key, fields)
    nothing = [F.lit(None).cast("string").alias(x) for x in ("field", "before", "after")]
    single = c.filter(F.col("kind").isin("new", "returned")).select(key, partition, "kind", *nothing)
    changed = c.filter("kind = 'changed'").select(key, partition, "kind", F.explode("diffs").alias("d")).select(key, partition, "kind", "d.*")
    gone = absent(staged, prior, key).filter(F.col("status") != "stale").join(complete.select(partition).distinct(), partition, "left_semi")
    return single.unionByName(changed).unionByName(gone.select(key, partition, F.lit("stale").alias("kind"), *nothing))


def carried_forward(staged: DataFrame, prior: DataFrame, key: str, partition: str, complete: DataFrame, seen_at: Column, touch: bool = False) -> DataFrame:
    """The next snapshot: staged rows, active and seen now, and prior rows that are absent.

    Absent rows of complete partitions go stale; others stay as they were.  Staged rows keep their first_seen.  Absent
    rows keep their last_seen, unless `touch` asks for the present in its place.
    """
    first = prior.select(key, F.col("first_seen").alias("__first"))
    live = staged.join(first, key, "left").withColumns({
        "status": F.lit("active"), "first_seen": F.coalesce("__first", seen_at), "last_seen": seen_at}).drop("__first")
    done = complete.select(F.col(partition).alias("__p")).distinct().withColumn("__done", F.lit(True))
    old = absent(staged, prior, key).join(done, F.col(partition) == F.col("__p"), "left")
    old = old.withColumn("status", F.when(F.col("__done"), "stale").otherwise(F.col("status")))
    if touch:
        old = old.withColumn("last_seen", seen_at)
    return live.unionByName(old.drop("__p", "__done").select(*live.columns))


def write_counts(staged: DataFrame, prior: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row: inserted, changed and unchanged rows."""
    c = classified(staged, prior, key, fields)
    return c.agg(F.count_if(F.col("kind") == "new").alias("inserted"), F.count_if(F.col("kind") == "changed").alias("changed"),
                 F.count_if(F.col("kind").isin("unchanged", "returned")).alias("unchanged"))


def upserted(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """old with new's rows in place of those with equal keys; of several the one with the greatest order."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    cols = old.columns
    return both.groupBy(*key).agg(F.max_by(F.struct(*cols), F.struct("__new", order)).alias("r")).select("r.*")


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the first in order; no group meets in one task whole."""
    return df.groupBy(*key).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def union_by_priority(parts: list[DataFrame], key: list[str], order: list[str]) -> DataFrame:
    """The union of parts; of rows with equal keys that of the earliest part, with its number as `priority`."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("priority", F.lit(i))
        out = p if out is None else out.unionByName(p)
    return first_wins(out, key, ["priority", *order])


def point_update(df: DataFrame, points: DataFrame, key: list[str], fields: list[str], order: str) -> DataFrame:
    """df with fields from points where there are such; of points with equal keys the last by order wins."""
    last = points.groupBy(*key).agg(F.max_by(F.struct(*fields), order).alias("__p"))
    out = df.join(last, key, "left")
    return out.withColumns({f: F.coalesce(F.col(f"__p.{f}"), F.col(f)) for f in fields}).drop("__p")


def unseen(df: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose hash is not in index.row_hash, each once, with the hash."""
    hashed = df.withColumn("row_hash", row_hash(df.columns, ROW))
    return hashed.join(index.select("row_hash"), "row_hash", "left_anti").dropDuplicates(["row_hash"])


def ledger(now: DataFrame, prior: DataFrame, partition: str, status: str = "ingest_status") -> DataFrame:
    """A row for each partition: this run's, unless it was not run and the prior one was."""
    n, p = now.alias("n"), prior.alias("p")
    both = n.join(p, F.col(f"n.{partition}") == F.col(f"p.{partition}"), "full_outer")
    old = F.col(f"n.{partition}").isNull() | ((F.col(f"n.{status}") == "not-run") & F.col(f"p.{partition}").isNotNull() & (F.col(f"p.{status}") != "not-run"))
    return both.select(*[F.when(old, F.col(f"p.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in now.columns])


def assert_state(prior: DataFrame, manifests: DataFrame) -> None:
    if prior.isEmpty() and not manifests.isEmpty():
        raise StateLost("manifests of earlier runs exist, but no prior rows")


def run_status(failed: int, total: int) -> str:
    return "failed" if failed == total else "partial" if failed else "complete"


def retained(versions: DataFrame, order: str, n: int = 4) -> DataFrame:
    """The newest n versions."""
    return versions.orderBy(F.col(order).desc()).limit(n)


def reconciled(ledger_rows: DataFrame, truth: DataFrame, partition: str) -> DataFrame:
    """partition, claimed, counted and verdict of ledger (partition, rows) and truth (partition, rows)."""
    a, b = ledger_rows.select(F.col(partition), F.col("rows").alias("claimed")), truth.select(F.col(partition), F.col("rows").alias("counted"))
    verdict = (F.when(F.col("claimed").isNull() & F.col("counted").isNull(), "unknown").when(F.col("claimed").isNull(), "missing-in-ledger")
               .when(F.col("counted").isNull(), "missing-in-truth").when(F.col("claimed") != F.col("counted"), "mismatch").otherwise("equal"))
    return a.join(b, partition, "full_outer").withColumn("verdict", verdict)


def repaired(ledger_rows: DataFrame, truth: DataFrame, partition: str, counters: list[str]) -> DataFrame:
    """The ledger with rows as counted; where they were wrong or missing, the other counters are unknown from now on."""
    n = truth.select(partition, F.col("rows").alias("__n"))
    out = ledger_rows.join(n, partition, "left")
    right = F.col("rows").eqNullSafe(F.col("__n"))
    return out.withColumns({c: F.when(right, F.col(c)) for c in counters} | {"rows": F.col("__n"), "was_right": right}).drop("__n")


def mirror_plan(source: DataFrame, target: DataFrame) -> DataFrame:
    """path, action (copy, keep, remove) and bytes of files (path, sha, bytes): a file is copied if its digest differs."""
    a = source.select("path", F.lower(F.regexp_replace("sha", "^sha256:", "")).alias("new"), F.col("bytes").alias("bytes"))
    b = target.select("path", F.lower(F.regexp_replace("sha", "^sha256:", "")).alias("old"))
    action = F.when(F.col("new").isNull(), "remove").when(F.col("new").eqNullSafe(F.col("old")), "keep").otherwise("copy")
    return a.join(b, "path", "full_outer").select("path", action.alias("action"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def recompute_counts(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """One row: how many values went up, went down or stayed."""
    j = old.select(key, F.col(value).alias("a")).join(new.select(key, F.col(value).alias("b")), key)
    return j.agg(F.count_if(F.col("b") > F.col("a")).alias("up"), F.count_if(F.col("b") < F.col("a")).alias("down"),
                 F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("same"))


def rolling_floor(df: DataFrame, partition: str, order: str, value: str, share: float, rows: int = 8) -> DataFrame:
    """df with the median of up to `rows` values before, and whether the value is under `share` of it."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(-rows, -1)
    return df.withColumn("median_before", F.percentile(value, 0.5).over(w)).withColumn(
        "under_floor", F.coalesce(F.col(value) < F.col("median_before") * share, F.lit(False)))
