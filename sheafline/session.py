"""Session settings shared by the queries, the tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "sheafline", cores: int | str = "*", memory: str = "12g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with adaptive execution on; a cluster passes its own settings with spark-submit instead."""
    os.environ.setdefault("TZ", "UTC")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the given tables; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, name: str = "files") -> str:
    """A new folder in the shared one that the session names; a local session without one takes a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_.isEmpty():
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
            set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = set_.get()
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written once in the shared folder and read again: its rows are settled, its lineage is cut and its size is known."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
