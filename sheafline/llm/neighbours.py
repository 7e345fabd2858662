"""Approximate nearest neighbours by low-dimensional stable projections.

Vectors are projected onto DIMS random Gaussian directions, which keep Euclidean distances in distribution: the squared
projected distance over the squared distance is chi-squared with DIMS degrees of freedom. A kd-tree on the projections,
with its upper splits fitted on a bounded sample (the projections of SAMPLE vectors of the least hash, PER_CELL at least to a
cell) and shared by all tasks, deals every vector to a cell. Within a task, a cell is a kd-tree down to leaves of LEAF vectors;
its leaves are taken in the order of their projected distance from the query, and their vectors verified by their true
distance, until the chi-square test holds: with d the k-th best distance so far, the query's own row left out, and r the
projected distance of the next leaf, any nearer vector would have been met with probability at least CONFIDENCE once
P(chi2 <= (r / d)^2) reaches it. In a first round each query searches its own cell; its k-th distance then shows which other
cells the test cannot rule out, and only these are searched in a second round. A small table is one cell, on the same path.

A cell of more than BLOCK vectors is dealt out in blocks, and more than QUERIES queries of a cell in blocks of queries, by the
cell's own counts, so that a task's work is bounded.
Equal vectors are one point with its k + 1 least ids, which is all that any result can hold of them. Vectors that are
null, zero or with a null or non-finite component take no part. Distances are taken between vectors of equal length: each length
has directions, a tree and cells of its own; a length that the sample lacks is one cell. Ties go to the smaller id; a repeated id
counts once per vector, and as a query it is the first of its vectors in their order. Fewer than k candidates give fewer rows;
empty tables give none.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K, DIMS, LEAF, SAMPLE, PER_CELL, CELL, BLOCK, QUERIES, CONFIDENCE = 10, 12, 64, 100_000, 16, 8192, 50_000, 2_000, 0.99


@lru_cache(maxsize=8)
def directions(size: int, dims: int = DIMS) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(size * 1000 + dims)).standard_normal((size, dims))


@lru_cache(maxsize=32)
def chi_square_limit(dims: int, confidence: float) -> float:
    """The value that a chi-squared variable stays under with this probability, by bisection of the incomplete gamma series."""

    def below(x):
        term = total = 1 / (dims / 2)
        for n in range(1, 1000):
            term *= (x / 2) / (dims / 2 + n)
            total += term
        return total * math.exp(-x / 2 + dims / 2 * math.log(x / 2) - math.lgamma(dims / 2)) if x > 0 else 0.0

    lo, hi = 0.0, dims + 40 * math.sqrt(dims)
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < confidence else (lo, mid)
    return hi


def usable(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    given = table.select(table[vec_id].cast("long").alias("vec_id"), table[vector].cast("array<double>").alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
    fine = "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vector, x -> x <> 0)"
    return given.where(fine)


def splits(points: np.ndarray, cells: int) -> list[tuple[int, float]]:
    """Splits of the upper kd-tree in heap order: (dimension, value), over 2^levels cells of about equal shares of the sample."""
    levels, out, parts = max(0, math.ceil(math.log2(max(1, cells)))), [], [points]
    for _ in range(levels):
        halves = []
        for p in parts:
            d = int(np.argmax(p.var(axis=0))) if len(p) else 0
            m = float(np.median(p[:, d])) if len(p) else 0.0
            out.append((d, m))
            halves += [p[p[:, d] <= m], p[p[:, d] > m]]
        parts = halves
    return out


def cell_of(points: np.ndarray, tree: list[tuple[int, float]]) -> np.ndarray:
    at = np.zeros(len(points), np.int64)
    for _ in range(int(math.log2(len(tree) + 1))):
        dims, cuts = np.array([t[0] for t in tree])[at], np.array([t[1] for t in tree])[at]
        at = 2 * at + 1 + (points[np.arange(len(points)), dims] > cuts)
    return at - len(tree)


def open_cells(points: np.ndarray, tree: list[tuple[int, float]], limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(point, cell) of all cells whose squared projected distance is within the point's limit, from the root of the tree down."""
    at, node, gap = np.arange(len(points)), np.zeros(len(points), np.int64), np.zeros(len(points))
    off = np.zeros(points.shape)  # the distance in each dimension
    axes, cuts = np.array([t[0] for t in tree], np.int64), np.array([t[1] for t in tree])
    for _ in range(int(math.log2(len(tree) + 1))):
        d, side = axes[node], points[at, axes[node]] - cuts[node]
        reach = np.maximum(off[np.arange(len(at)), d], np.abs(side))
        beyond = gap - off[np.arange(len(at)), d] ** 2 + reach**2
        far = np.flatnonzero(beyond <= limits[at])
        other = off[far]
        other[np.arange(len(far)), d[far]] = reach[far]
        near = 2 * node + 1 + (side > 0)
        node = np.concatenate([near, (4 * node + 3 - near)[far]])
        at, gap, off = np.concatenate([at, at[far]]), np.concatenate([gap, beyond[far]]), np.concatenate([off, other])
    return at, node - len(tree)


class Leaves:
    """A kd-tree over the projections of a block of vectors, as its leaves."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        todo, self.members = [np.arange(len(points))], []
        while todo:
            x = todo.pop()
            d = int(np.argmax(np.ptp(points[x], axis=0)))
            if len(x) <= leaf or np.ptp(points[x, d]) == 0:
                self.members.append(x)
                continue
            order = x[np.argsort(points[x, d], kind="stable")]
            todo += [order[: len(x) // 2], order[len(x) // 2 :]]
        self.low = np.array([points[x].min(axis=0) for x in self.members])
        self.high = np.array([points[x].max(axis=0) for x in self.members])

    def search(self, point, query, vectors, own, found, limit, k):
        """The k best (squared distance, row) for a query, starting from the best distances known; the rows in own are left out."""
        gap = (np.maximum(0, np.maximum(self.low - point, point - self.high)) ** 2).sum(axis=1)
        order = np.argsort(gap, kind="stable")
        best, at, step = found, 0, 4
        while at < len(order):
            worst = best[k - 1][0] if len(best) >= k else np.inf
            if gap[order[at]] > limit * worst:
                break
            rows = np.concatenate([self.members[x] for x in order[at : at + step]])
            d = ((vectors[rows] - query) ** 2).sum(axis=1)
            near = np.flatnonzero(d <= worst)
            best = sorted(best + [(d[x], rows[x]) for x in near if rows[x] not in own])[:k]
            at, step = at + step, min(2 * step, 64)
        return best


HITS = "query long, distance double, ids array<bigint>"


def _search(confidence: float, k: int):
    def run(key: tuple, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(points) and len(queries):
            points = points.sort_values("vec_id", kind="stable")
            vectors, ids = np.array(points["vector"].tolist()), points["ids"].tolist()
            across = directions(vectors.shape[1])
            projected, limit = vectors @ across, chi_square_limit(DIMS, confidence)
            leaves, asked = Leaves(projected), set(queries["vec_id"])
            # points that no one but the query itself holds
            own: dict[int, list[int]] = {}
            for row, held in enumerate(ids):
                if len(held) == 1 and held[0] in asked:
                    own.setdefault(held[0], []).append(row)
            for qid, vector, worst in queries.sort_values("vec_id")[["vec_id", "vector", "worst"]].itertuples(index=False):
                q = np.array(vector)
                # a bound known from another block stands for k candidates that are not in this one
                known = [] if not np.isfinite(worst) else [(worst**2 * (1 + 1e-12), len(vectors))] * k
                for d, row in leaves.search(q @ across, q, vectors, own.get(qid, ()), known, limit, k):
                    if row < len(vectors):
                        out.append((qid, math.sqrt(d), ids[row]))
        return pd.DataFrame(out, columns=["query", "distance", "ids"])

    return run


def _best(hits: DataFrame, k: int) -> DataFrame:
    """Rank within each query, nearest first, ties to the smaller id; Spark keeps k rows of a query and task before it shuffles."""
    each = hits.select("query", "distance", F.explode("ids").alias("vec_id")).where("vec_id <> query").distinct()
    return each.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "vec_id"))).where(F.col("rank") <= k)


def nearest(table: DataFrame, queries: DataFrame | None = None, k: int = K, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, vec_id and score (the distance) of the k nearest found for each query.

    queries has vec_id and embedding; without it, the rows whose vec_id is divisible by 100 are taken.
    """
    spark = table.sparkSession
    rows = usable(table)
    ranked = rows.withColumn("at", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    points = written(ranked.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.array_sort(F.collect_set("vec_id")).alias("ids")).withColumn("n", F.size("vector")), "points")
    count = points.count()
    asked = (usable(queries) if queries is not None else rows.where("vec_id % 100 = 0")).groupBy("vec_id").agg(F.min("vector").alias("vector"))

    @F.pandas_udf("array<double>")
    def project(vectors: pd.Series) -> pd.Series:
        return pd.Series([v @ directions(len(v)) for v in vectors])

    sample = points.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("n", project("vector").alias("p")).toPandas()
    trees = {}
    for n, part in sample.groupby("n"):
        trees[int(n)] = splits(np.array(part["p"].tolist()), min(-(-count * len(part) // len(sample) // CELL), max(1, len(part) // PER_CELL)))

    def by_length(vectors: pd.Series):
        """For each length among the vectors: their places, projections and tree."""
        sizes = vectors.map(len).to_numpy()
        for n in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == n)
            yield at, np.array(vectors.iloc[at].tolist()) @ directions(n), trees.get(n, [])

    @F.pandas_udf("long")
    def cell(vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), np.int64)
        for at, p, tree in by_length(vectors):
            out[at] = cell_of(p, tree)
        return pd.Series(out)

    @F.pandas_udf("array<long>")
    def others(vectors: pd.Series, worst: pd.Series) -> pd.Series:
        found = [[] for _ in vectors]
        for rows_, p, tree in by_length(vectors):
            at, cells = open_cells(p, tree, chi_square_limit(DIMS, confidence) * worst.to_numpy()[rows_] ** 2)
            away = cells != cell_of(p, tree)[at]
            for i, c in zip(rows_[at[away]].tolist(), cells[away].tolist(), strict=True):
                found[i].append(c)
        return pd.Series(found)

    placed = written(points.select("vec_id", "vector", "ids", "n", cell("vector").alias("cell")), "cells")
    home = written(asked.select("vec_id", "vector", F.size("vector").alias("n"), cell("vector").alias("cell")).withColumn("worst", F.lit(float("inf"))), "queries")
    # a row for each cell, of which there are as many as the sample allows
    blocks = written(placed.groupBy("n", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "cell-blocks")

    def search(these: DataFrame) -> DataFrame:
        """The hits of each query in its cell; every block of a cell's vectors meets every block of the cell's queries."""
        parts = written(blocks.join(these.groupBy("n", "cell").agg(F.ceil(F.count("*") / QUERIES).alias("deals")), ["n", "cell"]), "cell-parts")
        every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        mine = lambda c, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.col(c))
        dealt = these.join(parts, ["n", "cell"]).select("n", "cell", mine("deals", 4).alias("deal"), every("blocks").alias("block"), "vec_id", "vector", "worst")
        against = placed.join(parts.toDF("n", "cell", "n_blocks", "n_deals"), ["n", "cell"]).select("n", "cell", mine("n_blocks", 3).alias("block"), every("n_deals").alias("deal"), "vec_id", "vector", "ids")
        keys = ["n", "cell", "block", "deal"]
        return against.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(_search(confidence, k), HITS)

    hits = written(search(home), "hits")
    first = _best(hits, k).groupBy("query").agg(F.max("distance").alias("worst"), F.count("*").alias("found"))
    bound = home.drop("worst").join(first, home["vec_id"] == first["query"], "left").withColumn("worst", F.when(F.col("found") >= k, F.col("worst")).otherwise(F.lit(float("inf"))))
    again = written(bound.select("vec_id", "vector", "n", "worst", F.explode(others("vector", "worst")).alias("cell")), "other-cells")
    hits = hits.unionByName(written(search(again), "hits"))
    return _best(hits, k).select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", F.col("distance").alias("score"))
