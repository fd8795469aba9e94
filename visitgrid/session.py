"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
FILE_ROWS = 500_000
_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()


def build_session(app_name: str = "visitgrid", master: str | None = None, **settings: str) -> SparkSession:
    """Session with adaptive execution; cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Methods above 8000 bytes are never compiled by the JVM: typing many columns at
        # once is faster as several smaller methods.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not find it where they start."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="visitgrid-package-")
    archive = shutil.make_archive(os.path.join(folder, "visitgrid"), "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the checkpoint setting of the session.

    Only where it is unset and all runs in one process (tests) a local folder is
    chosen here, one per application.  On a cluster an unset folder is an error: each
    executor would write to a disk of its own.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="visitgrid-")
    return _LOCAL[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """New folder name below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back, so that several sinks reuse
    the rows and a lost executor never restarts the scan of the workbooks.

    With ``partition_by`` a reader that filters on that column opens its files only; a file
    has at most ``FILE_ROWS`` rows, as its rows are read by one task.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if partition_by:
        df.hint("rebalance", partition_by).write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
