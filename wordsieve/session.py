"""Session settings and scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, partitions: int | None = None, memory: str | None = None) -> SparkSession:
    """A session with the settings the jobs rely on; cluster sizes are left to the cluster."""
    builder = (
        SparkSession.builder.appName("wordsieve")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config(
            "spark.ui.showConsoleProgress", "false"
        )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    return builder.getOrCreate()


def share_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it; a cluster gets it with --py-files."""
    top = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if top not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{top}:{paths}".rstrip(":")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for stream checkpoints and intermediate tables.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local master, where
    every task sees the same disk, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix=f"wordsieve-{purpose}-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the scratch folder and read it back, for a result that several jobs need.

    Unlike a cache it outlives lost executors, and its size is known to the plans that read it.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
