"""The last record of each key of logs that grow, as a stream; records that cannot be read are set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """The lines of a folder's log files as they come."""
    return spark.readStream.option("maxFilesPerTrigger", files).text(path)


def parsed(lines_: DataFrame, schema: str, needed: list[str]) -> tuple[DataFrame, DataFrame]:
    """The records of lines of JSON, and the lines that hold none: cut off, not an object, or without what a record needs."""
    read = lines_.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"), F.try_parse_json("value").alias("v")).where("trim(value) <> ''")
    fine = F.col("v").isNotNull() & F.col("r").isNotNull()
    for c in needed:
        fine = fine & F.col(f"r.{c}").isNotNull()
    return read.where(fine).select("r.*"), read.where(~fine).select("value")


def latest(records: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The last record of each group in order, whatever the order in which they arrive: the state is one record for each group."""
    rest = [c for c in records.columns if c not in group]
    return records.groupBy(*group).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x")).select(*group, "x.*")


def follow(spark: SparkSession, path: str, out: str, schema: str, group: list[str], order: list[str], files: int = 1):
    """Keeps out/latest at the last record of each group and adds unreadable lines to out/aside; both streams resume from checkpoints
    in out. Returns the two queries; each round of files writes latest anew under a version and then names it in out/version."""
    good, bad = parsed(lines(spark, path, files), schema, [*group, *order])

    def replace(batch: DataFrame, version: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/latest/{version}")
        batch.sparkSession.createDataFrame([(version,)], "version long").coalesce(1).write.mode("overwrite").json(f"{out}/version")

    kept = latest(good, group, order).writeStream.outputMode("complete").option("checkpointLocation", f"{out}/checkpoint-latest").foreachBatch(replace).trigger(availableNow=True).start()
    aside = bad.writeStream.option("checkpointLocation", f"{out}/checkpoint-aside").format("parquet").trigger(availableNow=True).start(f"{out}/aside")
    return kept, aside


def current(spark: SparkSession, out: str) -> DataFrame:
    """The last records as of the last round that was written in full."""
    version = spark.read.schema("version long").json(f"{out}/version").first()["version"]
    return spark.read.parquet(f"{out}/latest/{version}")
