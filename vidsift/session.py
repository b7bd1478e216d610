"""Session set-up and the few settings every operator relies on."""

from __future__ import annotations

import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CALL_SITES = "spark.python.sql.dataFrameDebugging.enabled"  # static: only a session of our own can do without
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROOT = str(Path(__file__).resolve().parent.parent)


def build_session(app: str = "vidsift", cores: str = "8", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    conf = {
        "spark.master": f"local[{cores}]",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        CALL_SITES: "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("VIDSIFT_DRIVER_MEMORY", "8g"),
        "spark.driver.host": "127.0.0.1",
    } | extra
    spark = SparkSession.builder.appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when the driver runs from another folder."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *[x for x in have if x]])
    if spark.conf.get(ARROW_ROWS, "10000") == "10000":
        spark.conf.set(ARROW_ROWS, "2000")  # rows here hold whole texts
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all nodes share; a local session may do without the setting."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    return (at or "/tmp/checkpoints").rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows of a frame that several branches read, written once to the shared checkpoint folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided Parquet tables, read by Spark so that any store works."""
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")
