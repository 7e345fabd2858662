"""Seeded clusters and recruitment by distance: groups split by k-means, their centres and radii, rows taken by the nearest centre in reach."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .checks import running
from .select import capped_fill

#: Rows of a group, those of the least hash, of which its silhouettes are taken.
SILHOUETTE_ROWS = 1000
#: Points of a block in a join by distance, and rows of a block that are compared at once.
BLOCK, STRIPE = 4096, 256


def standardised(rows: DataFrame, features: list[Column], blocks: list[int]) -> DataFrame:
    """Adds x: each feature less its mean, over its deviation, and over the root of the size of its block, so that each block weighs the same.

    blocks: how many features, in order, each block has. A feature without spread becomes 0. One pass gives all means and deviations.
    """
    weights = [1 / math.sqrt(n) for n in blocks for _ in range(n)]
    if len(weights) != len(features):
        raise ValueError("the blocks must make up the features")
    got = rows.agg(*[f(c.cast("double")) for c in features for f in (F.avg, F.stddev_pop)]).first()
    scaled = [(c.cast("double") - F.lit(got[2 * i] or 0.0)) * F.lit(w / got[2 * i + 1] if got[2 * i + 1] else 0.0) for i, (c, w) in enumerate(zip(features, weights, strict=True))]
    return rows.withColumn("x", F.array(*scaled))


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d))


def lloyd(rows: DataFrame, group: str, key: str, most: int = 6, each: int = 10, rounds: int = 50) -> DataFrame:
    """group, k, c and centre: k-means of every group for every k from 2 to most (at most a k-th of each rows to a cluster), all in one loop.

    The first centres are the rows in the middle of k equal stretches of the group in the order of their first component. In each
    round every row meets one row of its group's centres, for all k at once, and means are combined before the shuffle. The loop
    ends when no centre moves; a cluster that loses all its rows keeps its centre.
    """
    dims = rows.select(F.size("x").alias("n")).limit(1).collect()
    if not dims:
        return rows.select(group, F.lit(None).cast("int").alias("k"), F.lit(None).cast("int").alias("c"), F.col("x").alias("centre"))
    sizes = rows.groupBy(group).agg(F.count("*").alias("n")).withColumn("top", F.least(F.lit(most), F.floor(F.col("n") / each)).cast("int")).where("top >= 2")
    sizes = written(sizes.withColumn("k", F.explode(F.sequence(F.lit(2), F.col("top")))).withColumn("c", F.explode(F.expr("sequence(0, k - 1)"))).withColumn("place", F.floor((F.col("c") + 0.5) * F.col("n") / F.col("k")).cast("long") + 1), "sizes")
    placed = running(rows.select(group, key, "x", F.get("x", F.lit(0)).alias("_first")), ["_first", key], F.lit(1), "place", [group])
    centres = written(sizes.select(group, "k", "c", "place").join(placed.select(F.col(group), "place", F.col("x").alias("centre")), [group, "place"]).select(group, "k", "c", "centre"), "centres")
    for _ in range(rounds):
        met = assigned(rows, centres, group, key).select(group, "x", F.explode("own").alias("o"))
        means = met.groupBy(group, F.col("o.k").alias("k"), F.col("o.c").alias("c")).agg(F.array(*[F.round(F.avg(F.get("x", F.lit(i))), 12) for i in range(dims[0]["n"])]).alias("mean"))
        after = written(centres.join(means, [group, "k", "c"], "left").select(group, "k", "c", F.coalesce("mean", "centre").alias("centre"), (F.coalesce("mean", "centre") != F.col("centre")).alias("moved")), "centres")
        centres = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    return centres


def assigned(rows: DataFrame, centres: DataFrame, group: str, key: str) -> DataFrame:
    """group, key, x and own: for each k the nearest centre (k, c), ties to the smaller c."""
    held = centres.groupBy(group, "k").agg(F.array_sort(F.collect_list(F.struct("c", "centre"))).alias("cs")).groupBy(group).agg(F.array_sort(F.collect_list(F.struct("k", "cs"))).alias("all"))
    nearest = lambda a: F.array_min(F.transform(a["cs"], lambda c: F.struct(_distance(F.col("x"), c["centre"]).alias("d"), c["c"].alias("c"))))["c"]
    return rows.select(group, key, "x").join(held, group).select(group, key, "x", F.transform("all", lambda a: F.struct(a["k"].alias("k"), nearest(a).alias("c"))).alias("own"))


def _silhouettes(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The mean silhouette for each k of a group's sample, of which there are SILHOUETTE_ROWS rows at most."""
    x = np.array(pdf["x"].tolist())
    d = np.sqrt(np.maximum(0, ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)))
    out = []
    for j, k in enumerate([o["k"] for o in pdf["own"].iloc[0]]):
        own = np.array([o[j]["c"] for o in pdf["own"]])
        found = np.unique(own)
        if len(found) > 1:
            means = np.stack([d[:, own == c].sum(axis=1) for c in found], axis=1)
            n = np.array([(own == c).sum() for c in found])
            at = np.searchsorted(found, own)
            inside = means[np.arange(len(x)), at] / np.maximum(1, n[at] - 1)
            other = means / n
            other[np.arange(len(x)), at] = np.inf
            outside = other.min(axis=1)
            s = np.where(n[at] > 1, (outside - inside) / np.maximum(np.maximum(inside, outside), 1e-300), 0.0)
            out.append((key[0], k, float(s.mean())))
    return pd.DataFrame(out, columns=["g", "k", "silhouette"])


def seeded_clusters(rows: DataFrame, group: str, key: str, most: int = 6, each: int = 10, least: int = 5, good: float = 0.5) -> DataFrame:
    """group, key, x and cluster of rows with group, key and x: each group whole, or in the k clusters of the best silhouette.

    Only a silhouette over good, and clusters of least rows and more, count; of equal ones the smaller k. Groups of less than
    2 * each rows stay whole. All groups and all k are fitted in the same jobs. Rows without a group are left out.
    """
    given = written(rows.where(F.col(group).isNotNull()).select(group, key, "x"), "features")
    centres = lloyd(given, group, key, most, each)
    own = written(assigned(given, centres, group, key), "assigned")
    first = Window.partitionBy(group).orderBy(F.xxhash64(key), key)
    sample = own.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= SILHOUETTE_ROWS)
    kind = given.schema[group].dataType.simpleString()
    scores = sample.groupBy(group).applyInPandas(_silhouettes, f"g {kind}, k int, silhouette double").withColumnRenamed("g", group)
    small = own.select(group, F.explode("own").alias("o")).groupBy(group, F.col("o.k").alias("k"), F.col("o.c").alias("c")).count().groupBy(group, "k").agg(F.min("count").alias("least"), F.count("*").alias("held"))
    fit = scores.join(small, [group, "k"]).where((F.col("least") >= least) & (F.col("held") == F.col("k")) & (F.col("silhouette") > good))
    best = fit.groupBy(group).agg(F.min_by("k", F.struct(-F.col("silhouette"), F.col("k"))).alias("best"))
    j = given.join(own.select(group, key, "own"), [group, key], "left").join(best, group, "left")
    chosen = F.filter("own", lambda o: o["k"] == F.col("best"))
    return j.select(group, key, "x", F.coalesce(F.get(chosen, F.lit(0))["c"], F.lit(0)).cast("long").alias("cluster"))


def pivots(centres: DataFrame, n: int = 3, rows: int = 1000) -> list[list[float]]:
    """Centres far from one another, of those with the least hashes."""
    some = [r["centre"] for r in centres.select(F.col("centre").cast("array<double>").alias("centre")).orderBy(F.xxhash64("centre")).limit(rows).collect()]
    if not some:
        return []
    points = np.array(some)
    picked, near = [0], np.linalg.norm(points - points[0], axis=1)
    while len(picked) < n and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(points - points[picked[-1]], axis=1))
    return [some[i] for i in picked]


def _flat(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix; a null component becomes NaN."""
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _packed(points: DataFrame, name: str, vector: str, at: list[list[float]], width: float, by: list[str]) -> DataFrame:
    """Blocks of at most BLOCK points that agree in by and in their number of components: _block, by, _n, _lo and _hi, _names, _data, _radius.

    Points lie in the order of by and of the cells of their distances to the pivots, in sorted ranges, so a block's distances to each
    pivot are bounded by _lo and _hi, the points' radii included. Points without a vector or with a null or NaN in it reach nothing and
    are left out. Within a block, points are in the order of their names.
    """

    def measured(batches):
        for batch in batches:
            size = pc.list_value_length(batch.column("_v"))
            for n in pc.unique(size.drop_null()).to_pylist():
                rows = batch.filter(pc.equal(size, n))
                x = _flat(rows.column("_v")) if n else np.zeros((len(rows), 0))
                good = ~np.isnan(x).any(axis=1)
                x, rows = x[good], rows.filter(pa.array(good))
                d = np.stack([np.sqrt(((x - np.array(p)) ** 2).sum(axis=1)) if len(p) == n else np.zeros(len(x)) for p in at], axis=1) if at else np.zeros((len(x), 0))
                listed = lambda y: pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), y.shape[1]).cast(pa.list_(pa.float64())) if y.size else pa.array([[]] * len(y), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(len(x), n, np.int32)), listed(d), listed(np.floor(d / width))], [*rows.schema.names, "_n", "_d", "_cell"])

    df = points.select(F.col(name).alias("_name"), F.col(vector).cast("array<double>").alias("_v"), F.col("radius").cast("double").alias("_radius"), *by)
    df = df.mapInArrow(measured, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields], "_n int, _d array<double>, _cell array<double>"]))
    order = [*by, "_n", "_cell", "_name"]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    put = ", ".join(["_block long", *[f"`{c}` {kinds[c]}" for c in by], "_n int", f"_names array<{kinds['_name']}>", "_data binary, _radius binary, _lo array<double>, _hi array<double>"])

    def pack(batches):
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0

        def block(held, key):
            nonlocal made
            t = pa.Table.from_batches(held)
            t = t.take(pc.sort_indices(t, [("_name", "ascending")], null_placement="at_start")).combine_chunks().to_batches()[0]
            d, r = _flat(t.column("_d")), np.asarray(t.column("_radius"), dtype=float)
            e = (r[:, None] + 1e-9 * (d + r[:, None])) if d.size else d  # the second term is for rounding
            one = lambda x, kind: pa.array([x], kind)
            keys = [pa.array([k], t.column(c).type) for c, k in zip([*by, "_n"], key, strict=True)]
            names = pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), t.column("_name"))
            bounds = [one((d - e).min(axis=0).tolist(), pa.list_(pa.float64())), one((d + e).max(axis=0).tolist(), pa.list_(pa.float64()))]
            made += 1
            return pa.RecordBatch.from_arrays([one((task << 32) + made, pa.int64()), *keys, names, one(_flat(t.column("_v")).tobytes(), pa.binary()), one(r.tobytes(), pa.binary()), *bounds], ["_block", *by, "_n", "_names", "_data", "_radius", "_lo", "_hi"])

        held, size, at = [], 0, None
        for batch in batches:
            keys, i = list(zip(*[batch.column(c).to_pylist() for c in [*by, "_n"]], strict=True)), 0
            while i < len(keys):
                if held and (keys[i] != at or size == BLOCK):
                    yield block(held, at)
                    held, size = [], 0
                at, j = keys[i], i + 1
                while j < len(keys) and keys[j] == at and size + j - i < BLOCK:
                    j += 1
                held.append(batch.slice(i, j - i))
                size, i = size + j - i, j
        if held:
            yield block(held, at)

    return written(df.repartitionByRange(*order).sortWithinPartitions(*order).drop("_cell").mapInArrow(pack, put), "blocks")


def _all_distances(a: np.ndarray, b: np.ndarray, whole: bool) -> np.ndarray:
    """The distance of each row of a to each of b, as the sum of squares component by component gives it; for whole numbers a product
    of matrices gives the same sums, exactly."""
    if whole:
        return np.sqrt((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T))
    sums = np.zeros((len(a), len(b)))
    with np.errstate(invalid="ignore"):  # of infinite components
        for i in range(a.shape[1]):
            d = a[:, i, None] - b[:, i]
            sums += d * d
    return np.sqrt(sums)


def _met(rows: DataFrame, key: str, vector: str, centres: DataFrame, center: str, found: Callable, columns: str, by: tuple[str, str] | None = None, agree: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """What found(names, centres' names, distances, within reach) makes of every pair of a block of rows and one of centres.

    By the triangle inequality a row's distance to any pivot differs from that of a centre in reach by the radius at most, so pairs of
    blocks whose bounds leave a gap are left out; so are those that agree() takes from the pairs of what rows and centres are told apart
    by. All distances of the other pairs are computed, a stripe of rows at a time, and the test is exact. Each pair is a row of a table,
    and the pairs are spread over the cluster: a task holds two blocks, however many rows and centres there are.
    """
    at = pivots(centres)
    width = centres.agg(F.avg(F.col("radius").cast("double"))).first()[0] or 1.0
    level = F.ceil(F.log2(F.greatest(F.col("radius").cast("double"), F.lit(width / 4096)))).cast("int").alias("_level")  # wide radii apart from narrow ones
    own, other = ([by[0]], [by[1]]) if by else ([], [])
    a = _packed(rows.select(key, vector, *own, F.lit(0.0).alias("radius")), key, vector, at, width, own)
    b = _packed(centres.where("radius >= 0").select(center, "centre", "radius", *other, level), center, "centre", at, width, [*other, "_level"])
    ends = lambda df, p, more: df.select(*more, *[F.col(c).alias(f"{p}{c}") for c in ("_block", "_n", "_lo", "_hi")])
    all_ = lambda x, y, f: F.forall(F.zip_with(x, y, f), lambda c: c)
    pairs = ends(a, "a", own).join(ends(b, "b", other), F.col("a_n") == F.col("b_n"))
    pairs = pairs.where(all_("a_hi", "b_lo", lambda x, y: x >= y) & all_("a_lo", "b_hi", lambda x, y: x <= y))
    pairs = written((agree(pairs) if agree else pairs).select("a_block", "b_block"), "pairs")
    side = lambda df, p: df.select(F.col("_n").alias(f"{p}_n"), *[F.col(c).alias(f"{p}{c}") for c in ("_block", "_names", "_data", "_radius")])
    both = pairs.join(side(a, "a").drop("a_radius"), "a_block").join(side(b, "b").drop("b_n"), "b_block")
    both = both.repartition(min(max(pairs.count(), 1), 10_000), "a_block", "b_block").select("a_n", "a_names", "a_data", "b_names", "b_data", "b_radius")

    def compare(batches):
        for batch in batches:
            for i in range(len(batch)):
                x = {c: batch.column(c)[i] for c in batch.schema.names}
                get = lambda c: np.frombuffer(x[c].as_buffer())  # noqa: E731, B023
                p, q = get("a_data").reshape(len(x["a_names"].values), -1), get("b_data").reshape(len(x["b_names"].values), -1)
                most = max(np.abs(p).max(initial=0), np.abs(q).max(initial=0))
                whole = bool(4 * most * most * p.shape[1] < 2**53 and (p == np.floor(p)).all() and (q == np.floor(q)).all())
                for k in range(0, len(p), STRIPE):
                    d = _all_distances(p[k : k + STRIPE], q, whole)
                    yield from found(x["a_names"].values.slice(k, STRIPE), x["b_names"].values, d, d <= get("b_radius"))

    return both.mapInArrow(compare, columns)


def in_reach(rows: DataFrame, key: str, vector: str, centres: DataFrame, center: str) -> DataFrame:
    """key, centre's name and distance for all rows within a centre's radius; centres: name, centre, radius. See _met()."""

    def found(names, others, d, near):
        i, j = np.nonzero(near)
        if len(i):
            yield pa.RecordBatch.from_arrays([names.take(pa.array(i)), others.take(pa.array(j)), pa.array(d[i, j])], ["_key", "_centre", "distance"])

    kind = lambda df, c: df.schema[c].dataType.simpleString()
    met = _met(rows, key, vector, centres, center, found, f"_key {kind(rows, key)}, _centre {kind(centres, center)}, distance double")
    return met.select(F.col("_key").alias(key), F.col("_centre").alias(center), "distance")


def nearest(rows: DataFrame, key: str, vector: str, centres: DataFrame, center: str, by: tuple[str, str] | None = None, agree: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """key, the nearest centre in reach, its distance, that of the next one (null if there is none) and how many centres are in reach.

    Ties go to the smaller name; rows that reach no centre are left out. by names a column of the rows and one of the centres, and
    agree() keeps the pairs of their values that may meet. Each pair of blocks tells each row's two nearest centres and the number in
    reach, so what is shuffled grows with rows times blocks of centres, not with the pairs in reach. See _met().
    """

    def found(names, others, d, near):
        reached = near.sum(axis=1)
        some = np.flatnonzero(reached)
        if not len(some):
            return
        d, out = np.where(near[some], d[some], np.inf), []
        for k in range(2):
            at = d.argmin(axis=1)  # the first one: centres are in the order of their names
            has = reached[some] > k
            out += [pa.array(d[np.arange(len(some)), at], mask=~has), others.take(pa.array(at, mask=~has))]
            d[np.arange(len(some)), at] = np.inf
        yield pa.RecordBatch.from_arrays([names.take(pa.array(some)), pa.array(reached[some].astype(np.int64)), *out], ["_key", "_reached", "_d0", "_c0", "_d1", "_c1"])

    kind = lambda df, c: df.schema[c].dataType.simpleString()
    met = _met(rows, key, vector, centres, center, found, f"_key {kind(rows, key)}, _reached long, _d0 double, _c0 {kind(centres, center)}, _d1 double, _c1 {kind(centres, center)}", by, agree)
    each = [F.when(F.col(f"_d{k}").isNotNull(), F.struct(F.col(f"_d{k}").alias("d"), F.col(f"_c{k}").alias("c"))) for k in range(2)]
    per = met.groupBy("_key").agg(F.sort_array(F.flatten(F.collect_list(F.array_compact(F.array(*each))))).alias("_two"), F.sum("_reached").alias("reached"))
    two = lambda k: F.get("_two", F.lit(k))
    return per.select(F.col("_key").alias(key), two(0)["c"].alias(center), two(0)["d"].alias("distance"), two(1)["d"].alias("next"), "reached")


def compatible(pairs: DataFrame, taxon: str, other: str, tree: DataFrame, domains: list) -> DataFrame:
    """Pairs whose taxa agree: none known, an ancestor (or the same) that itself lies in a domain, or a descendant; tree: node, ancestor."""
    up = tree.select(F.col("node").alias("_n"), F.col("ancestor").alias("_a")).distinct()
    rooted = up.where(F.col("_a").isin(domains)).select(F.col("_n").alias(taxon)).distinct().withColumn("_rooted", F.lit(True))
    above = up.select(F.col("_n").alias(other), F.col("_a").alias(taxon)).withColumn("_above", F.lit(True))
    below = up.select(F.col("_n").alias(taxon), F.col("_a").alias(other)).withColumn("_below", F.lit(True))
    j = pairs.join(above, [other, taxon], "left").join(below, [taxon, other], "left").join(rooted, taxon, "left")
    return j.where("_below OR (_above AND _rooted) OR " + f"`{taxon}` IS NULL").drop("_above", "_below", "_rooted")


def proposals(rows: DataFrame, key: str, vector: str, taxon: str, centres: DataFrame, center: str, center_taxon: str, tree: DataFrame, domains: list, ratio: float = 0.75) -> DataFrame:
    """key, centre and distance: the nearest compatible centre in reach, unless the next is not farther by the ratio. Ties go to the smaller name."""
    agree = lambda pairs: compatible(pairs, taxon, center_taxon, tree, domains)
    found = nearest(rows, key, vector, centres, center, (taxon, center_taxon), agree)
    return found.where(F.col("next").isNull() | (F.col("distance") <= F.lit(ratio) * F.col("next"))).select(key, center, "distance")


def recruited(rows: DataFrame, found: DataFrame, key: str, center: str, size: str, held: DataFrame, cap: int) -> DataFrame:
    """key, centre, distance and taken: proposals accepted nearest first while the centre's rows stay under a cap; held: centre, size so far."""
    given = found.join(rows.select(key, size), key).join(held.select(center, F.col("size").alias("_held")), center, "left")
    # what a bin holds already is its first row, which always fits if anything does
    base = held.select(F.lit(None).cast(rows.schema[key].dataType).alias(key), F.col(center), F.lit(-1.0).alias("distance"), F.least(F.col("size"), F.lit(cap)).cast("long").alias("_size"))
    both = given.select(key, center, "distance", F.col(size).cast("long").alias("_size")).unionByName(base)
    return capped_fill(both, center, ["distance", key], "_size", cap).where("distance >= 0").select(key, center, "distance", "taken")
