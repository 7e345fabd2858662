"""Comparisons of tables: what is on one side only, equal sets, overrides, latest records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each distinct key and where it is: both, left_only or right_only."""
    a = left.select(key).distinct().withColumn("_l", F.lit(True))
    b = right.select(key).distinct().withColumn("_r", F.lit(True))
    place = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left_only").otherwise("right_only")
    return a.join(b, key, "full").select(key, place.alias("place"))


def latest(log: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The last record of each group in an append-only log."""
    rest = [c for c in log.columns if c not in group]
    return log.groupBy(*group).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x")).select(*group, "x.*")


def override(rows: DataFrame, given: DataFrame, key: str, level: str, value: str) -> DataFrame:
    """Rows with a given value for (level, key), else for the key at any level (a null level), else none.

    The alternative of the two conditions is two equal joins, not one join on an OR.
    """
    exact = given.where(F.col(level).isNotNull()).select(key, level, F.col(value).alias("_exact"))
    any_ = given.where(F.col(level).isNull()).select(key, F.col(value).alias("_any"))
    return rows.join(exact, [key, level], "left").join(any_, key, "left").withColumn(value, F.coalesce("_exact", "_any")).drop("_exact", "_any")


def same_sets(members: DataFrame, group: str, key: str) -> DataFrame:
    """For each group: its number of distinct keys, and whether it holds the same ones as the smallest group name does.

    Sets are compared by their size and two order-free sums of hashes, so that no set has to be gathered.
    """
    per = members.select(group, key).distinct().groupBy(group).agg(F.count("*").cast("long").alias("n"), F.sum(F.crc32(F.col(key).cast("string").cast("binary"))).alias("h"), F.bit_xor(F.xxhash64(key)).alias("g"))
    first = per.agg(F.min_by(F.struct("n", "h", "g"), group).alias("f"))
    return per.join(F.broadcast(first)).select(group, "n", (F.struct("n", "h", "g") == F.col("f")).alias("same"))


def running(rows: DataFrame, order: list, value: Column, name: str, group: list[str] | None = None) -> DataFrame:
    """Adds the running sum of a whole number in order, the row itself included, over the whole table or within each group.

    The table is sorted in ranges and written once, with the number of its range beside each row, so that all that is read of it
    afterwards agrees on the ranges. Each range sums its own rows and starts from the sum of the ranges before it; no task sees all
    rows, nor all rows of a large group. Rows with equal keys follow one another in no set order: give a key that is unique.
    """
    group = group or []
    ranged = rows.withColumn("_value", F.coalesce(value.cast("long"), F.lit(0))).repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    sums = ranged.groupBy(*group, "_part").agg(F.sum("_value").alias("_sum"))
    # a row for each range, and for each group in it
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = sums.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"), before.alias("_before"))
    inner = F.sum("_value").over(Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    same = [F.col("_part") == F.col("_p"), *[F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]]
    met = ranged.withColumn("_inner", inner).join(before, reduce(lambda a, b: a & b, same))
    return met.withColumn(name, F.col("_before") + F.col("_inner")).drop("_part", "_p", "_value", "_inner", "_before", *[f"_g{i}" for i in range(len(group))])


def numbered(rows: DataFrame, order: list, prefix: str, width: int) -> DataFrame:
    """Sequential identifiers in order, counted in sorted ranges (see running())."""
    return running(rows, order, F.lit(1), "_k").withColumn("new_id", F.concat(F.lit(prefix), F.lpad(F.col("_k").cast("string"), width, "0"))).drop("_k")


def median_with_zeros(rows: DataFrame, group: str, value: str, length: int) -> DataFrame:
    """Exact median, breadth and coefficient of variation of length positions of which only the non-zero ones are rows."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("_n"))
    per = counts.groupBy(group).agg(F.sum("_n").alias("_covered"), F.sum(F.col(value) * F.col("_n")).alias("_s"), F.sum(F.col(value) * F.col(value) * F.col("_n")).alias("_q"))
    run = counts.join(per, group).withColumn("_top", F.col("_n") + F.sum("_n").over(Window.partitionBy(group).orderBy(value)) - F.col("_n") + length - F.col("_covered"))
    at = lambda k: F.coalesce(F.min(F.when(F.col("_top") >= k, F.col(value))), F.lit(0))
    lo, hi = at((length + 1) // 2), at(length // 2 + 1)
    few = lambda k, x: F.when(F.max(F.lit(length) - F.col("_covered")) >= k, F.lit(0)).otherwise(x)
    mean = F.max("_s") / length
    var = F.max("_q") / length - mean * mean
    return run.groupBy(group).agg(
        F.round(mean, 6).alias("mean_depth"), ((few((length + 1) // 2, lo) + few(length // 2 + 1, hi)) / 2.0).alias("median_depth"),
        F.round(F.max("_covered") / length, 6).alias("breadth"), F.round(F.when(mean > 0, F.sqrt(F.greatest(var, F.lit(0.0))) / mean), 4).alias("cv"),
    )


def freshness(current: DataFrame, recorded: DataFrame, key: str) -> DataFrame:
    """key and source_state: whether the recorded digest is the current one; without a record nothing is verified, a record without a
    current row has lost its bin. Both have key and digest."""
    old = recorded.select(key, F.col("digest").alias("_old"))
    j = current.select(key, F.col("digest").alias("_new")).join(old, key, "full")
    state = F.when(F.col("_new").isNull(), "missing_bin").when(F.col("_old").isNull(), "unverified").when(F.col("_old") == F.col("_new"), "current").otherwise("stale_input")
    return j.select(key, state.alias("source_state"))


def top_each(rows: DataFrame, group: list[str], order: list, k: int, name: str = "k") -> DataFrame:
    """The first k rows of each group in order, numbered."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(w).cast("long")).where(F.col(name) <= k)
