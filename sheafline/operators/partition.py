"""Fallback names, partitions of small groups, and their verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checks import running
from .graph import cut

UNCLASSIFIED = "Unclassified"


def labels(calls: list[str], suffix: Column, genus: int | None = None) -> Column:
    """An array with the label a contig has when it is named from each level: struct(label, level).

    calls are columns from the highest rank on, null where there is no call; the last one is the rank of the bins. A name
    above it gets a fallback form: "unclassified X" at the top, "X sp." at the genus, else "X suffix".
    """
    last = len(calls) - 1
    out = []
    for start in range(last + 1):
        chain = F.struct(F.lit(UNCLASSIFIED).alias("label"), F.lit(-1).alias("level"))
        for i in range(start + 1):
            name = F.col(calls[i])
            shown = name if i == last else F.concat(F.lit("unclassified "), name) if i == 0 else F.concat(name, F.lit(" sp.")) if i == genus else F.concat(name, F.lit(" "), suffix)
            chain = F.when(name.isNotNull(), F.struct(shown.alias("label"), F.lit(i).alias("level"))).otherwise(chain)
        out.append(chain)
    return F.array(*out)


def cascade(contigs: DataFrame, size: str, least: int, least_contigs: int = 1, rounds: int = 9) -> DataFrame:
    """Contigs with their final label; contigs has an array options (from labels()).

    Groups that are too small fall to the next level that their members have a name at, until none is, in at most so many
    rounds as the definition allows; groups named at the top level stay. A round is an aggregation by label and a join with the
    small labels; its result is cut off, so that plans do not grow.
    """
    now = contigs.withColumn("_now", F.element_at("options", -1))
    for _ in range(rounds):
        per = now.groupBy(F.col("_now.label").alias("label")).agg(F.sum(size).alias("_size"), F.count("*").alias("_count"), F.max("_now.level").alias("_top"))
        small = cut(per.where((F.col("label") != UNCLASSIFIED) & (F.col("_top") > 0) & ((F.col("_size") < least) | (F.col("_count") < least_contigs))).select(F.col("label").alias("_small")))
        if small.isEmpty():
            break
        joined = now.join(small, F.col("_now.label") == F.col("_small"), "left")
        lower = F.when(F.col("_now.level") > 0, F.get("options", F.col("_now.level") - 1)).otherwise(F.struct(F.lit(UNCLASSIFIED).alias("label"), F.lit(-1).alias("level")))
        now = cut(joined.withColumn("_now", F.when(F.col("_small").isNotNull(), lower).otherwise(F.col("_now"))).drop("_small"))
    return now.withColumn("label", F.col("_now.label")).drop("_now", "options")


def verify(assembly: DataFrame, membership: DataFrame, key: str, size: str, bin_: str) -> DataFrame:
    """Parts of an assembly: each bin and an Unbinned remainder, with contigs and sizes, and the number of contigs in two bins."""
    per = membership.groupBy(key).agg(F.min(bin_).alias("part"), F.countDistinct(bin_).alias("_bins"))
    placed = assembly.join(per, key, "left").withColumn("part", F.coalesce("part", F.lit("Unbinned")))
    return placed.groupBy("part").agg(F.count("*").cast("long").alias("contigs"), F.sum(size).cast("long").alias("bp"), F.sum((F.col("_bins") > 1).cast("int")).alias("o")).select("part", "contigs", "bp", F.coalesce("o", F.lit(0)).cast("long").alias("overlapping"))


def dictionary(rows: DataFrame, column: str, order: str) -> DataFrame:
    """Codes of the distinct values in the order in which they are first seen, counted in sorted ranges."""
    firsts = rows.groupBy(F.coalesce(F.col(column), F.lit("NA")).alias("level")).agg(F.min(order).alias("_first"), F.count("*").cast("long").alias("n"))
    return running(firsts, ["_first", "level"], F.lit(1), "_k").select("level", "n", (F.col("_k") - 1).cast("long").alias("code"))
