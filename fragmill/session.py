"""Session defaults, and how Python workers get this package."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()


def session(master: str = "local[*]", **settings: str) -> SparkSession:
    """A session with UTC, AQE and Arrow on; settings come last and win (dots written as __)."""
    builder = (
        SparkSession.builder.master(master)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers, unless their path has it already."""
    places = [Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    application = spark.sparkContext.applicationId
    if ROOT in places or application in _SHIPPED:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/fragmill", "zip", ROOT, "fragmill")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def work_folder(spark: SparkSession) -> str:
    """A new folder that all executors share: below spark.checkpoint.dir, or, with a local master only, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/ingest-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The same rows from a checkpoint in the shared folder: lineage ends, and how they are partitioned stays known."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint()
