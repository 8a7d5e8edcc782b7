"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", cores: str = "*", **conf) -> SparkSession:
    """A session with the settings the library assumes. On a cluster pass
    nothing but ``app``: master, shuffle partitions and memory belong to
    ``spark-submit``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if cores:
        builder = builder.master(f"local[{cores}]").config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` when the
    cluster names one. A temporary folder is used only in local mode, where
    driver and executors are one process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, by: Sequence[str] = (), texts: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. Cuts lineage, and
    the result survives the loss of any executor. ``by``: columns by whose values
    rows lie in folders, so that a filter on them reads only its own rows. ``texts``:
    it holds whole texts, which zstd makes a third smaller than the default codec."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path, compression="zstd" if texts else None)
    return df.sparkSession.read.schema(df.schema).parquet(path)
