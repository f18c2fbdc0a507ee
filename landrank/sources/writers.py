"""Writers: append once, upsert, and versions behind a pointer."""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landrank.operators.delta import upserted


class AlreadyWritten(ValueError):
    """The run's rows are there already."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def renamed(spark: SparkSession, source: str, target: str, replace: bool = False) -> bool:
    """Renames in one step; false if the target is there already and not to be replaced."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    rule = hadoop.Options.Rename.OVERWRITE if replace else hadoop.Options.Rename.NONE
    rules = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    rules[0] = rule
    try:
        hadoop.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration()).rename(old, new, rules)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()) or exists(spark, target):
            return False
        raise
    return True


def append_once(df: DataFrame, path: str, run_id: str, fmt: str = "json") -> None:
    """Appends a run's rows, by month and run id; refuses a run that is there already.

    Rows are written aside and renamed to the run's own folder in one step: a job that fails leaves no part of a run,
    and of two writers of a run one is refused.
    """
    spark = df.sparkSession
    folder = f"{path}/month={run_id[:7]}"
    target = f"{folder}/run_id={quote(run_id, safe='-_.')}"
    if exists(spark, target):
        raise AlreadyWritten(run_id)
    aside = f"{path}/_run-{uuid.uuid4().hex}"
    df.write.format(fmt).save(aside)
    fs, p = _fs(spark, folder)
    fs.mkdirs(p)
    if not renamed(spark, aside, target):
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(aside), True)
        raise AlreadyWritten(run_id)


def write_upsert(df: DataFrame, path: str, version: str, key: list[str], order: str, old: str | None = None) -> str:
    """Writes the table with df's rows upserted as a new version; returns its path."""
    new = f"{path}/{version}"
    base = upserted(df.sparkSession.read.parquet(old), df, key, order) if old else df
    base.write.parquet(new)
    return new


def read_pointer(spark: SparkSession, path: str) -> dict:
    """The pointer; a missing one, or one to nothing, is refused."""
    fs, p = _fs(spark, f"{path}/pointer.json")
    if not fs.exists(p):
        raise FileNotFoundError(f"{path}/pointer.json")
    pointer = json.loads(spark.read.text(f"{path}/pointer.json", wholetext=True).first()[0])
    if not exists(spark, pointer["current"]):
        raise FileNotFoundError(pointer["current"])
    return pointer


def swap_pointer(spark: SparkSession, path: str, target: str, digest: str, failed: int = 0, keep: int = 4) -> bool:
    """Points to a new version, keeps the last ones; nothing happens if the digest is the same or a partition failed."""
    fs, p = _fs(spark, f"{path}/pointer.json")
    old = read_pointer(spark, path) if fs.exists(p) else None
    if failed or (old and old["digest"] == digest):
        return False
    history = [{"current": target, "digest": digest}, *(old["history"] if old else [])][:keep]
    aside = f"{path}/pointer-{uuid.uuid4().hex}.tmp"
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(aside), False)
    out.write(bytearray(json.dumps({"current": target, "digest": digest, "history": history}).encode()))
    out.close()
    return renamed(spark, aside, f"{path}/pointer.json", replace=True)  # there is a pointer at any time


def published(tables: dict[str, DataFrame], path: str, version: str) -> str:
    """Writes tables as JSON to a folder of their own in a version, all or none of them, and returns the version's path.

    They are written aside and the version appears in one step; a version that is there already is refused.
    """
    spark = next(iter(tables.values())).sparkSession
    aside, target = f"{path}/_version-{uuid.uuid4().hex}", f"{path}/{version}"
    for name, df in tables.items():
        df.write.json(f"{aside}/{name}")
    if not renamed(spark, aside, target):
        fs, p = _fs(spark, aside)
        fs.delete(p, True)
        raise AlreadyWritten(version)
    return target


def manifest(spark: SparkSession, path: str, run: dict, counties: DataFrame) -> dict:
    """A run's manifest with totals over its counties (county, rows, inserted, changed, unchanged), written as JSON in one step."""
    names = ("rows", "inserted", "changed", "unchanged")
    total = counties.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.count(F.lit(1)).alias("counties")).first().asDict()
    fs, _ = _fs(spark, path)
    aside = f"{path}/manifest-{uuid.uuid4().hex}.tmp"
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(aside), False)
    out.write(bytearray(json.dumps(run | {"totals": total}, sort_keys=True).encode()))
    out.close()
    renamed(spark, aside, f"{path}/{run['run_id']}.json", replace=True)
    return total
