"""Assembly metrics: Nx and Lx, totals by rank, coverage profiles, robust outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nx_lx(rows: DataFrame, group: list[str], size: str, shares: tuple[int, ...] = (50,)) -> DataFrame:
    """For each percentage x: the size at which the running sum from the largest reaches x % of the whole, and how many it takes.

    Sizes are counted before the window, so that a group takes part with its distinct sizes only.
    """
    counted = rows.groupBy(*group, size).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*group)
    order = whole.orderBy(F.desc(size))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    run = counted.withColumn("_sum", F.sum(F.col(size) * F.col("_n")).over(upto)).withColumn("_count", F.sum("_n").over(upto)).withColumn("_all", F.sum(F.col(size) * F.col("_n")).over(whole))
    before = F.col("_sum") - F.col(size) * F.col("_n")
    out = []
    for x in shares:
        at = (100 * F.col("_sum") >= x * F.col("_all")) & ((100 * before < x * F.col("_all")) | (F.col("_sum") == F.col("_all")))
        # the rows of equal size that are still needed
        need = F.ceil((F.lit(x) * F.col("_all") / 100 - before) / F.greatest(F.col(size), F.lit(1)))
        out += [F.max(F.when(at, F.col(size))).cast("long").alias(f"n{x}"), F.min(F.when(at, F.col("_count") - F.col("_n") + F.greatest(need, F.lit(1)))).cast("long").alias(f"l{x}")]
    return run.groupBy(*group).agg(*out)


def summary(rows: DataFrame, group: list[str], size: str) -> DataFrame:
    """Count, sum, extremes, mean and exact median of a size."""
    return rows.groupBy(*group).agg(
        F.count("*").cast("long").alias("contigs"), F.sum(size).cast("long").alias("bp"), F.max(size).cast("long").alias("longest"), F.min(size).cast("long").alias("shortest"),
        F.round(F.avg(size), 4).alias("mean_len"), F.median(size).alias("median_len"),
    )


def rank_totals(bins: DataFrame, rank: str, size: str, classified, name: str) -> DataFrame:
    """Bins, classified ones, sizes, the classified share and the largest bin of each rank."""
    held = F.sum(F.when(classified, F.col(size)).otherwise(0))
    return bins.groupBy(rank).agg(
        F.count("*").cast("long").alias("bins"), F.sum(F.when(classified, 1).otherwise(0)).cast("long").alias("classified"), F.sum(size).cast("long").alias("bp"),
        F.round(held / F.sum(size), 6).alias("classified_fraction"), F.min_by(name, F.struct(-F.col(size), F.col(name))).alias("largest"),
    )


def profile(depths: DataFrame, group: str, pos: str, depth: str, length: int, window: int) -> DataFrame:
    """Tumbling windows over positions 0..length-1 with missing positions as depth 0, without making a row for each position.

    Every group gets all its windows: those without depth are made from the group's total, which also gives a window's flag.
    """
    some = depths.groupBy(group, F.floor(F.col(pos) / window).cast("long").alias("window_no")).agg(F.sum(depth).alias("total"), F.countDistinct(pos).alias("covered"))
    windows = -(-length // window)
    all_ = some.groupBy(group).agg(F.sum("total").alias("all"))
    each = all_.withColumn("window_no", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(windows - 1).cast("long")))).join(some, [group, "window_no"], "left")
    width = F.least(F.lit(window), F.lit(length) - F.col("window_no") * window)
    mean, whole = F.coalesce("total", F.lit(0)) / width, F.col("all") / length
    flag = F.when(mean == 0, "zero_coverage").when(mean < 0.2 * whole, "low_relative_depth").when(mean > 3 * whole, "high_relative_depth").otherwise("")
    return each.select(group, "window_no", F.round(mean, 6).alias("mean_depth"), F.round(F.coalesce("covered", F.lit(0)) / width, 6).alias("covered_fraction"), flag.alias("flag"))


def exact_median(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """group and median (of the non-null values): values are counted first and then ranked, so that no group is held in one buffer."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_upto", F.sum("_n").over(order)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*group)))
    at = lambda k: F.min(F.when(F.col("_upto") >= k, F.col(value)))
    return placed.groupBy(*group).agg(((at(F.floor((F.col("_all") + 1) / 2)) + at(F.floor(F.col("_all") / 2) + 1)) / 2.0).alias("median"))


def weighted_if_complete(rows: DataFrame, group: list[str], value: str, weight: str) -> DataFrame:
    """Weighted mean of a value where all members of a group have one, and how many have."""
    whole = F.count("*") == F.count(value)
    return rows.groupBy(*group).agg(F.round(F.when(whole, F.sum(F.col(value) * F.col(weight)) / F.sum(weight)), 6).alias("weighted"), F.count(value).cast("long").alias("known"))


def strided(rows: DataFrame, place: str, stride: int, value: str) -> DataFrame:
    """Mean and number of the values of each stride of places."""
    return rows.groupBy(F.floor(F.col(place) / stride).cast("long").alias("stride")).agg(F.round(F.avg(value), 4).alias("mean"), F.count("*").cast("long").alias("n"))


def tiles(rows: DataFrame, group: list[str], sample: str, size: str) -> DataFrame:
    """Samples, bins, summed size and median size of each group."""
    per = rows.groupBy(*group).agg(F.countDistinct(sample).cast("long").alias("samples"), F.count("*").cast("long").alias("bins"), F.sum(size).cast("long").alias("bp"))
    return per.join(exact_median(rows, group, size), group).select(*group, "samples", "bins", "bp", F.col("median").alias("median_size"))


def robust(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """Median and median absolute deviation of each group."""
    centres = exact_median(rows, group, value).withColumnRenamed("median", "med")
    spread = exact_median(rows.join(centres, group).withColumn("_d", F.abs(F.col(value) - F.col("med"))), group, "_d").withColumnRenamed("median", "mad")
    return centres.join(spread, group)
