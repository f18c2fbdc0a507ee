"""Sessions with the settings that the library relies on."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build(name: str = "landrank", **conf: str) -> SparkSession:
    """A session with UTC and adaptive execution; conf adds to or replaces settings."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | conf
    return SparkSession.builder.appName(name).config(map=settings).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    A session with a local master gets such a folder where none is set; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared folder: cuts the lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, where they may not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_landrank_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="spark-")
    keep = pathlib.Path(folder) / "package"
    shutil.copytree(root, keep / root.name, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(pathlib.Path(folder) / "landrank"), "zip", keep))
    context._landrank_shipped = True
