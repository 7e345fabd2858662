"""Weighted votes for a name at each rank, and the consensus of a group's calls."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

UNCLASSIFIED = "Unclassified"


def best_hits(hits: DataFrame, run: str, score: str, order: list[str], keep: float = 0.9, most: int = 5) -> DataFrame:
    """The hits of each run within a share of its best score, then the first few of them; ties keep their order.

    One shuffle on the run serves both windows.
    """
    whole = Window.partitionBy(run)
    near = hits.withColumn("_best", F.max(score).over(whole)).where((F.col("_best") > 0) & (F.col(score) >= F.lit(keep) * F.col("_best")))
    place = F.row_number().over(whole.orderBy(F.desc(score), *order))
    return near.withColumn("_place", place).where(F.col("_place") <= most).drop("_best", "_place")


def rank_votes(hits: DataFrame, contig: str, ranks: list[str], names: str, score: str, order: list[str], least: float = 0.5, denominator: str = "all") -> DataFrame:
    """contig, rank, taxon and support.

    names is an array of structs with a field for each rank. A hit's score is split evenly among its distinct names at a
    rank; it counts once in full in the denominator, with "named" only where it has a name there. The heaviest name wins,
    the first one met on a tie; below the least support the name becomes Unclassified and the support stays.
    """
    per_rank = F.array(*[F.struct(F.lit(i).alias("rank"), F.expr(f"array_distinct(filter(transform({names}, x -> x.{r}), x -> x IS NOT NULL))").alias("taxa")) for i, r in enumerate(ranks)])
    long = hits.select(contig, score, F.struct(*order).alias("_order"), F.explode(per_rank).alias("r")).select(contig, score, "_order", "r.rank", "r.taxa")
    named = F.size("taxa") > 0
    total = long.groupBy(contig, "rank").agg(F.sum(F.col(score) if denominator == "all" else F.when(named, F.col(score)).otherwise(F.lit(0).cast("decimal(18,2)"))).alias("total"))
    split = long.where(named).select(contig, "rank", "_order", (F.col(score) / F.size("taxa")).cast("decimal(24,6)").alias("part"), F.posexplode("taxa").alias("_k", "taxon"))
    weights = split.groupBy(contig, "rank", "taxon").agg(F.sum("part").alias("weight"), F.min(F.struct("_order", "_k")).alias("first"))
    first = Window.partitionBy(contig, "rank").orderBy(F.desc("weight"), "first")
    won = weights.withColumn("_place", F.row_number().over(first)).where("_place = 1")
    both = total.join(won, [contig, "rank"], "left")
    share = F.col("weight").cast("double") / F.col("total").cast("double")
    return both.select(
        contig,
        "rank",
        F.when(F.col("weight") >= F.lit(least) * F.col("total"), F.col("taxon")).otherwise(F.lit(UNCLASSIFIED)).alias("taxon"),
        F.when(F.col("total") > 0, F.coalesce(F.round(share, 4), F.lit(0.0))).otherwise(F.lit(0.0)).alias("support"),
    )


def unanimous(calls: DataFrame, group: list[str], taxon: str) -> DataFrame:
    """The one name that all called members share, else Unclassified; support 1 or 0."""
    called = F.when(F.col(taxon) != UNCLASSIFIED, F.col(taxon))
    one = calls.groupBy(*group).agg(F.min(called).alias("_lo"), F.max(called).alias("_hi"))
    same = F.col("_lo") == F.col("_hi")
    return one.select(*group, F.when(same, F.col("_lo")).otherwise(F.lit(UNCLASSIFIED)).alias("taxon"), F.when(same, 1.0).otherwise(0.0).alias("support"))


def majority(members: DataFrame, group: list[str], name: str, size: str) -> DataFrame:
    """The name that holds the most of a group's size; ties go to the smaller name."""
    summed = members.groupBy(*group, name).agg(F.sum(size).alias("held"))
    return summed.groupBy(*group).agg(F.max(F.struct("held", F.col(name))).alias("x"), F.min(F.struct(-F.col("held"), F.col(name).alias("n"))).alias("y")).select(*group, F.col("y.n").alias(name), F.col("x.held").alias("held"))


def fingerprints(hits: DataFrame, contig: str) -> DataFrame:
    """contig and fingerprint of all its hits, whatever their order: their number and two sums of hashes, combined before the shuffle."""
    row = F.xxhash64(*[F.col(c) for c in hits.columns])
    per = hits.groupBy(contig).agg(F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(row).alias("x"))
    return per.select(contig, F.sha2(F.concat_ws(":", "n", "s", "x"), 256).alias("fingerprint"))


def cached_votes(hits: DataFrame, contig: str, vote: Callable[[DataFrame], DataFrame], cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The votes of all contigs with the fingerprint of the hits they come from, and the contigs that were voted on again.

    cache is an earlier result. Contigs whose hits are still those of the cache keep its votes; only the hits of the others are voted on;
    contigs without hits now are dropped. vote makes a table with a column contig; hits whose contig is null have no vote.
    """
    now = written(fingerprints(hits.where(F.col(contig).isNotNull()), contig), "fingerprints")
    if cache is None:
        changed = now.select(contig)
        kept = None
    else:
        before = cache.select(contig, F.col("fingerprint").alias("_f")).distinct()
        changed = written(now.join(before, contig, "left").where(~F.col("fingerprint").eqNullSafe(F.col("_f"))).select(contig), "changed")
        kept = cache.join(now, [contig, "fingerprint"], "left_semi")
    again = vote(hits.join(changed, contig, "left_semi")).join(now, contig)
    return (again if kept is None else kept.select(*again.columns).unionByName(again)), changed
