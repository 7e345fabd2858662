"""Interval unions and overlap joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def union_length(rows: DataFrame, group: list[str], lo: str, hi: str, inclusive: bool = False) -> DataFrame:
    """Length and number of islands of the union of intervals; inclusive ends merge when adjacent.

    Repeated intervals are dropped before the window. Each interval adds what reaches beyond all before it.
    """
    before = Window.partitionBy(*group).orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, -1)
    top = F.max(hi).over(before)
    seen = rows.select(*group, lo, hi).distinct().withColumn("_top", top)
    one = 1 if inclusive else 0
    adds = F.greatest(F.lit(0), F.col(hi) + one - F.greatest(F.col(lo), F.coalesce(F.col("_top") + one, F.col(lo))))
    starts = F.col("_top").isNull() | (F.col(lo) > F.col("_top") + one)
    return seen.groupBy(*group).agg(F.sum(adds).cast("long").alias("union_bp"), F.sum(starts.cast("int")).cast("long").alias("islands"))


def overlap_join(left: DataFrame, right: DataFrame, key: str, width: int) -> DataFrame:
    """Pairs of left (key, l_lo, l_hi, ...) and right (key, r_lo, r_hi, ...) that share a position, ends included.

    Both sides are dealt to buckets of a width, which makes this an equal join; a pair that shares several buckets is kept
    in the one where the later of the two starts.
    """
    bucket = lambda c: F.floor(F.col(c) / width).cast("long")
    a = left.withColumn("_bucket", F.explode(F.sequence(bucket("l_lo"), bucket("l_hi"))))
    b = right.withColumn("_bucket", F.explode(F.sequence(bucket("r_lo"), bucket("r_hi"))))
    same = a.join(b, [key, "_bucket"]).where("l_hi >= r_lo AND l_lo <= r_hi")
    return same.where(F.col("_bucket") == F.greatest(bucket("l_lo"), bucket("r_lo"))).drop("_bucket")


def islands(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """Contiguous runs of a value in order within each group: runs, distinct values, and runs of values met before."""
    w = Window.partitionBy(*group).orderBy(*order)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    marked = rows.select(*group, value, new.alias("_new"))
    return marked.groupBy(*group).agg(F.sum("_new").cast("long").alias("runs"), F.countDistinct(value).cast("long").alias("distinct_values")).withColumn("noncontiguous", F.col("runs") - F.col("distinct_values"))
