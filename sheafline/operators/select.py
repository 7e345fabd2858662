"""Choosing rows: best with a margin, evenly spaced, capped fills, seeded samples, searches, polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..session import written


def best_without_tie(rows: DataFrame, group: list[str], score: str, order: list[str], ratio: float = 0.9) -> DataFrame:
    """The best row of each group, unless the second one has at least a share of its score."""
    w = Window.partitionBy(*group).orderBy(F.desc(score), *order)
    two = rows.withColumn("_k", F.row_number().over(w)).where("_k <= 2")
    both = two.groupBy(*group).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in group]), "_k").alias("b"), F.max(F.when(F.col("_k") == 2, F.col(score))).alias("_second"))
    return both.where(F.col("_second").isNull() | (F.col("_second") < F.lit(ratio) * F.col(f"b.{score}"))).select(*group, "b.*")


def reciprocal(scored: DataFrame, q: str, s: str, score: str, ratio: float = 0.9) -> DataFrame:
    """Pairs that are each other's best hit without a near tie."""
    ahead = best_without_tie(scored.select(q, s, score), [q], score, [s], ratio)
    back = best_without_tie(scored.select(s, q, score), [s], score, [q], ratio).select(F.col(s).alias("_s"), F.col(q).alias("_q"))
    return ahead.join(back, (F.col(s) == F.col("_s")) & (F.col(q) == F.col("_q"))).drop("_s", "_q")


def spaced(n: Column, cap: int) -> Column:
    """Positions 1..n, all of them up to cap, else cap of them evenly spaced, halves rounded to the even number."""
    if cap == 1:
        few = F.array((1 + F.floor((n - 1) / 2)).cast("long"))
    else:
        few = F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda i: (1 + F.bround(i * (n - 1) / (cap - 1))).cast("long"))
    return F.when(n <= cap, F.sequence(F.lit(1).cast("long"), n)).otherwise(few)


def seeded_sample(key: Column, share: float) -> Column:
    """True for a share of the keys: CRC-32 with initial state 17, which four leading bytes bring about."""
    return F.crc32(F.concat(F.unhex(F.lit("4656D26C")), key.cast("string").cast("binary"))) < F.lit(int(share * 2**32)).cast("long")


def capped_fill(rows: DataFrame, group: str, order: list[str], size: str, cap: int) -> DataFrame:
    """Rows taken in order as long as they fit under a cap; one that does not fit is passed over and later ones may still fit.

    In rounds over all groups at once: rows are taken up to the first that does not fit, and of those after it the ones larger than
    the room left can never fit and go; the rest are the next round's. Running sums are made in sorted ranges, so a large group is
    spread over tasks. Rows with equal order keys follow one another by their size and then their other columns. A null or negative size takes no room.
    """
    names = rows.columns
    # maps have no order; their text has
    key = [F.to_json(c) if isinstance(rows.schema[c].dataType, MapType) else F.col(c) for c in names if c not in (group, size, *order)]
    key = [*map(F.col, order), F.col("_size"), *key]
    sized = rows.withColumn("_size", F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)))
    ranged = written(sized.repartitionByRange(F.col(group), *key).withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()), "fill")
    rest = ranged.where(F.col("_size") <= cap).select(F.col(group).alias("_g"), "_part", "_id", "_size", F.row_number().over(Window.partitionBy(group, "_part").orderBy(*key)).alias("_k"))
    rest, room, taken = written(rest, "fill"), None, None
    while not rest.isEmpty():
        # sums within the parts of a group, and before each part
        before = F.coalesce(F.sum("_s").over(Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        parts = rest.groupBy("_g", "_part").agg(F.sum("_size").alias("_s")).select(F.col("_g").alias("_h"), F.col("_part").alias("_p"), before.alias("_before"))
        inner = F.sum("_size").over(Window.partitionBy("_g", "_part").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0))
        at = rest.withColumn("_sum", inner).join(parts, F.col("_g").eqNullSafe(F.col("_h")) & (F.col("_part") == F.col("_p")))
        at = at.withColumn("_sum", F.col("_sum") + F.col("_before")).drop("_h", "_p", "_before")
        at = at.withColumn("_left", F.lit(cap).cast("long")) if room is None else at.join(room, at["_g"].eqNullSafe(room["_h"])).drop("_h")
        # sizes are not negative, so sums only grow and the taken rows of a round come before its first misfit
        now = at.where("_sum <= _left").select("_id")
        taken = now if taken is None else taken.unionByName(now)
        per = at.groupBy(F.col("_g").alias("_h")).agg((F.max("_left") - F.coalesce(F.max(F.when(F.col("_sum") <= F.col("_left"), F.col("_sum"))), F.lit(0))).alias("_left"))
        after = written(per, "fill")
        left = at.where("_sum > _left").drop("_sum", "_left")
        rest, room = written(left.join(after, left["_g"].eqNullSafe(after["_h"])).where("_size <= _left").drop("_h", "_left"), "fill"), after
    if taken is None:
        return ranged.select(*names, F.lit(False).alias("taken"))
    return ranged.join(taken.select("_id", F.lit(True).alias("_taken")), "_id", "left").select(*names, F.coalesce("_taken", F.lit(False)).alias("taken"))


def search(columns: list[str], query: str) -> Column:
    """Comma means or, a leading - excludes; each part is looked for in all columns, whatever the case."""
    text = F.lower(F.concat_ws("\n", *columns))
    parts = [p.strip().lower() for p in query.split(",") if p.strip()]
    wanted = [text.contains(p) for p in parts if not p.startswith("-")]
    out = F.lit(True) if not wanted else wanted[0]
    for c in wanted[1:]:
        out = out | c
    for p in parts:
        if p.startswith("-") and p[1:]:
            out = out & ~text.contains(p[1:])
    return out


def in_polygon(x: Column, y: Column, corners: list[tuple[float, float]]) -> Column:
    """Even-odd rule over the edges."""
    inside = F.lit(False)
    for (ax, ay), (bx, by) in zip(corners, corners[-1:] + corners[:-1], strict=True):
        cross = ((F.lit(ay) > y) != (F.lit(by) > y)) & (x < F.lit(bx - ax) * (y - F.lit(ay)) / F.lit(by - ay if by != ay else 1.0) + F.lit(ax))
        inside = inside != cross
    return inside


def sanitised(name: Column) -> Column:
    """A name for files: all but letters and digits of any script, dots, underscores and hyphens as underscores, none at the ends."""
    return F.regexp_replace(F.regexp_replace(name, r"[^\p{L}\p{N}._-]", "_"), "^_+|_+$", "")


def centroids(rows: DataFrame, group: str, vector: str) -> DataFrame:
    """group and centre: the mean of each component of whole-number vectors, rounded down."""
    parts = rows.select(group, F.posexplode(vector).alias("_i", "_x")).groupBy(group, "_i").agg(F.floor(F.avg("_x")).cast("long").alias("_c"))
    return parts.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_c"))), lambda x: x["_c"]).alias("centre"))
