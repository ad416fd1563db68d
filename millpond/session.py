"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "millpond", **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    ``conf`` names use ``__`` for dots (``spark__sql__shuffle__partitions="8"``).
    On a cluster leave ``master`` unset and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a temporary folder of its
    own; a cluster session is refused, since its executors share no local disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="millpond-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, never reused by another run."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


_SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, label: str, swept: bool = False) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For frames that an iterative job scans many times: the plan before is cut,
    a lost executor costs no recomputation, and later scans read only the
    columns they need. ``swept`` removes the shuffle files of the write at its end, not
    when the driver happens to collect garbage.
    """
    conf, path = df.sparkSession.conf, new_folder(df.sparkSession, label)
    before = conf.get(_SWEEP, None)
    if swept:
        conf.set(_SWEEP, "true")
    try:
        df.write.parquet(path)
    finally:
        if swept:
            conf.set(_SWEEP, before) if before is not None else conf.unset(_SWEEP)
    return df.sparkSession.read.parquet(path)
