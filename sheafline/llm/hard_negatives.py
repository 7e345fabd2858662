"""Hard negatives by exact windowed inner-product search in cover trees over norm-augmented vectors.

Every vector c gets one more component, sqrt(M^2 - |c|^2), with M the greatest norm of the table. All augmented vectors then lie
on one sphere, and the inner product of an anchor q with c is |q| M cos(angle between them). The nodes of a cover tree are
balls on this sphere: a node's centre is one of its own vectors, its covering radius the widest angle to any vector below it.
With t the angle between the anchor and a centre and r the radius, every inner product below the node lies between
|q| M cos(t + r) and |q| M cos(t - r). The descent opens the nodes in the order of their upper bound, skips those outside all
windows that are still open, and computes the inner products of a leaf's vectors exactly.

The top level of the tree spans the cluster: centres are picked farthest first from a bounded sample (SAMPLE vectors of the least
hash), every vector goes to its nearest centre, and the radius of such a cell is taken over all its vectors. Below it, each
block of at most about BLOCK vectors of a cell is a tree of its own, built in the task: FANOUT centres at most of each node
are picked farthest first, so they are at least the level's covering radius apart. An anchor searches its own cell first;
the k-th score found there shows which other cells can hold better ones. The windows of the negatives are known before
their search, so it goes once to all cells that meet one of them. Blocks meet the anchors that need them in deals of ANCHORS.

Rows with a null vec_id, label or vector, or with a null or non-finite component take no part. Inner products are taken between
vectors of equal length only; each length has its own cells. Equal rows count once; rows that share an id but differ are
rows of their own, and an anchor never meets a row of its own id. Of rows with equal vector and label the k + 1 least ids are kept, which is all that any result can hold of them.
Scores are exact whole numbers; while M^2 is under 2^53 they are computed as doubles, beyond that as Python integers.
Ties go to the smaller id. Fewer rows than k give fewer rows, windows without a row none; empty tables give an empty result.
Other columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K, SCALE, SAMPLE, CELLS, CELL, BLOCK, ANCHORS, FANOUT, LEAF = 5, 256, 20_000, 512, 8192, 16_384, 512, 16, 32
#: Added to covering radii and taken off bounds, for the rounding of angles.
SLACK = 1e-6


def usable(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, vector (whole numbers) and n, its length, of the rows that take part."""
    given = table.select(table[vec_id].cast("long").alias("vec_id"), table[label].cast("long").alias("label"), table[vector].cast("array<double>").alias("vector"))
    fine = "vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    whole = F.transform("vector", lambda x: F.floor(x * SCALE).cast("long"))
    return given.where(fine).select("vec_id", "label", whole.alias("vector"), F.size("vector").alias("n"))


def relabelled(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """The label of each row whose id is divisible by every moves on by one."""
    return rows.withColumn("label", F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))


def matrix(vectors) -> np.ndarray:
    """Vectors of one length as rows of whole numbers, exact as doubles or else as Python integers."""
    found = np.array([np.asarray(v, dtype=np.int64) for v in vectors], dtype=np.int64).reshape(len(vectors), -1)
    plain = found.astype(np.float64)
    return plain if not len(plain) or (plain**2).sum(axis=1).max() < 2**52 else found.astype(object)


def augmented(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Unit vectors: each with the component that brings it to the common norm, divided by it."""
    plain = vectors.astype(np.float64) / norm
    return np.concatenate([plain, np.sqrt(np.maximum(0.0, 1.0 - (plain**2).sum(axis=1)))[:, None]], axis=1)


def angles(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angles between unit vectors, by the chord, which is accurate for small ones."""
    return 2 * np.arcsin(np.clip(np.sqrt(((points - centre) ** 2).sum(axis=-1)) / 2, 0.0, 1.0))


def farthest_first(points: np.ndarray, most: int, share: float = 0.5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the centres, the centre of each point, and its angle to it. Ends once all points are within share of the first radius."""
    picked, near, at = [0], angles(points, points[0]), np.zeros(len(points), np.int64)
    enough = share * near.max()
    while len(picked) < most and (row := int(np.argmax(near))) is not None and near[row] > enough:
        d = angles(points, points[row])
        closer = d < near
        near[closer], at[closer] = d[closer], len(picked)
        picked.append(row)
    return np.array(picked), at, near


class CoverTree:
    """Nodes over unit vectors: centre, covering radius, children; a leaf has its rows instead."""

    def __init__(self, points: np.ndarray, fanout: int = FANOUT, leaf: int = LEAF):
        self.centres, self.radius, self.children, self.rows = [points[0]], [float(angles(points, points[0]).max()) + SLACK], [None], [None]
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= leaf or self.radius[node] <= 2 * SLACK:
                self.rows[node] = rows
                continue
            picked, at, near = farthest_first(points[rows], fanout)
            first = len(self.centres)
            for c, p in enumerate(picked):
                mine = at == c
                self.centres.append(points[rows[p]])
                self.radius.append(float(near[mine].max()) + SLACK)
                self.children.append(None)
                self.rows.append(None)
                todo.append((first + c, rows[mine]))
            self.children[node] = np.arange(first, first + len(picked))
        self.centres, self.radius = np.array(self.centres), np.array(self.radius)

    def bounds(self, nodes: np.ndarray, unit: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
        return bounds(self.centres[nodes], self.radius[nodes], unit, scale)

    def search(self, query: np.ndarray, unit: np.ndarray, scale: float, vectors: np.ndarray, ids: np.ndarray, allowed: np.ndarray, windows: list, k: int) -> list[list[tuple[int, int]]]:
        """For each window (low, high, known) the k best (score, row) among the allowed rows with low <= score <= high, greatest
        first, ties to the smaller id. known is a score that k rows of the window reach elsewhere, or None.

        unit is the augmented query as a unit vector, scale its norm times that of the vectors.
        """
        best = [[] for _ in windows]
        least = [low if known is None else max(low, known) for low, _, known in windows]
        nodes = np.array([0])
        low, high = self.bounds(nodes, unit, scale)
        step = 4
        while len(nodes):
            open_ = np.zeros(len(nodes), bool)
            for (_, top, _), floor in zip(windows, least, strict=True):
                open_ |= (low <= top) & (high >= floor)
            nodes, low, high = nodes[open_], low[open_], high[open_]
            if not len(nodes):
                break
            order = np.argsort(-high, kind="stable")
            now, later = order[:step], order[step:]
            step = min(2 * step, 64)
            inner = [self.children[x] for x in nodes[now] if self.children[x] is not None]
            rows = [self.rows[x] for x in nodes[now] if self.rows[x] is not None]
            if rows:
                rows = np.concatenate(rows)
                rows = rows[allowed[rows]]
                scores = vectors[rows] @ query
                for w, (_, top, _) in enumerate(windows):
                    for x in np.flatnonzero((scores <= top) & (scores >= least[w])):
                        best[w].append((int(scores[x]), int(rows[x])))
                    best[w] = sorted(best[w], key=lambda x: (-x[0], ids[x[1]]))[:k]
                    if len(best[w]) == k:
                        least[w] = max(least[w], best[w][-1][0])
            nodes, low, high = nodes[later], low[later], high[later]
            if inner:
                inner = np.concatenate(inner)
                more = self.bounds(inner, unit, scale)
                nodes, low, high = np.concatenate([nodes, inner]), np.concatenate([low, more[0]]), np.concatenate([high, more[1]])
        return best


def bounds(centres: np.ndarray, radius: np.ndarray, unit: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that a vector within the radius of a centre can have with the query."""
    t = angles(centres, unit)
    slack = scale * SLACK + SLACK
    return scale * np.cos(np.minimum(np.pi, t + radius)) - slack, scale * np.cos(np.maximum(0.0, t - radius)) + slack


def _anchor(vector: np.ndarray, norm: float) -> tuple[np.ndarray, float]:
    """The augmented query as a unit vector (its own added component is zero), and the scale of its inner products."""
    plain = vector.astype(np.float64)
    size = math.sqrt(float((plain**2).sum()))
    return np.append(plain / size if size else plain, 0.0), size * norm


class Top:
    """The tree's top level: for each vector length the centres (unit vectors) of its cells. A length without any has one cell, 0."""

    def __init__(self, centres: dict[int, np.ndarray], norm: float):
        self.centres, self.norm = centres, norm

    @classmethod
    def fit(cls, sample: list, count: int, norm: float) -> Top:
        """sample: vectors; count: of all rows."""
        by_size: dict[int, list] = {}
        for v in sample:
            by_size.setdefault(len(v), []).append(v)
        found = {}
        for n, vs in by_size.items():
            points = augmented(matrix(vs), norm)
            cells = min(CELLS, math.ceil(count * len(vs) / len(sample) / CELL), len(vs))
            found[n] = points[farthest_first(points, cells, 0.0)[0]]
        return cls(found, norm)

    def place(self, vectors: pd.Series) -> pd.DataFrame:
        """The cell of each vector and its angle to the cell's centre."""
        cell, angle = np.zeros(len(vectors), np.int64), np.full(len(vectors), np.pi)
        sizes = vectors.map(len).to_numpy()
        for n in np.unique(sizes):
            if n in self.centres:
                mine = np.flatnonzero(sizes == n)
                points = augmented(matrix(vectors.iloc[mine]), self.norm)
                every = np.stack([angles(points, c) for c in self.centres[n]])
                cell[mine], angle[mine] = every.argmin(axis=0), every.min(axis=0)
        return pd.DataFrame({"cell": cell, "angle": angle})


HITS = "anchor long, anchor_hash long, place int, score long, ids array<long>"


def _search(norm: float, k: int, same: bool):
    """Positives (same label, one window without ends) or negatives (another label, a window for each positive) of a deal of anchors in a block."""

    def run(key: tuple, points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(points) and len(asked):
            points = points.sort_values("vec_id", kind="stable")
            ids, labels, held = points["vec_id"].to_numpy(), points["label"].to_numpy(), points["ids"].tolist()
            vectors = matrix(points["vector"])
            tree = CoverTree(augmented(vectors, norm))
            of_label = {x: labels == x for x in asked["label"].unique()}
            for anchor, hash_, label, vector, low, high, known in asked[["vec_id", "hash", "label", "vector", "low", "high", "known"]].itertuples(index=False):
                query = matrix([vector])[0].astype(vectors.dtype)
                unit, scale = _anchor(query, norm)
                allowed = of_label[label] if same else ~of_label[label]
                # vectors that only the anchor's id holds
                lone = [r for r in np.flatnonzero((ids == anchor) & allowed) if len(held[r]) == 1]
                if lone:
                    allowed = allowed.copy()
                    allowed[lone] = False
                windows = [(int(a), int(b), None if np.isnan(c) else c) for a, b, c in zip(low, high, known, strict=True)] if low is not None else [(-np.inf, np.inf, None)]
                for place, found in enumerate(tree.search(query, unit, scale, vectors, ids, allowed, windows, k)):
                    out += [(anchor, hash_, place, score, held[row]) for score, row in found]
        return pd.DataFrame(out, columns=["anchor", "anchor_hash", "place", "score", "ids"])

    return run


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and window, no row of the anchor's own id; Spark keeps k rows of a task before it shuffles."""
    w = Window.partitionBy("anchor", "anchor_hash", "place").orderBy(F.desc("score"), "vec_id")
    each = hits.select("anchor", "anchor_hash", "place", "score", F.explode("ids").alias("vec_id")).where("vec_id <> anchor")
    return each.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(table: DataFrame, rows: DataFrame | None = None, anchors: DataFrame | None = None, k: int = K, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of the k best negatives of each anchor and positive.

    A negative's score is at most the positive's, and at least share[0] / share[1] of it. rows is a table of usable() that replaces
    the given table's own; anchors is a part of it, by default the rows whose id is divisible by 100.
    """
    spark = table.sparkSession
    rows = relabelled(usable(table)) if rows is None else rows
    rows = rows.select("vec_id", "label", "vector", "n").distinct()
    hash_ = F.xxhash64("vector", "label")
    asked = written((rows.where(F.col("vec_id") % 100 == 0) if anchors is None else anchors).withColumn("hash", hash_), "anchors")
    kept = rows.withColumn("at", F.row_number().over(Window.partitionBy("vector", "label").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    points = written(kept.groupBy("vector", "label", "n").agg(F.min("vec_id").alias("vec_id"), F.array_sort(F.collect_list("vec_id")).alias("ids")), "points")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    count, most = points.agg(F.count("*"), F.max(square)).first()
    norm = math.sqrt(most or 0.0) * (1 + 1e-9) or 1.0
    sample = points.select("vector", F.xxhash64("vec_id").alias("h")).orderBy("h").limit(SAMPLE).collect()
    top = Top.fit([x["vector"] for x in sample], count, norm)

    @F.pandas_udf("cell long, angle double")
    def place(vectors: pd.Series) -> pd.DataFrame:
        return top.place(vectors)

    placed = written(points.withColumn("at", place("vector")).select("vec_id", "label", "vector", "n", "ids", "at.cell", "at.angle"), "cells")
    # a row for each cell, of which there are as many as the sample allows, and one for each further length
    cells = written(placed.groupBy("n", "cell").agg(F.max("angle").alias("radius"), F.ceil(F.count("*") / BLOCK).alias("blocks")), "cell-blocks")
    radius = {(r["n"], r["cell"]): r["radius"] + SLACK for r in cells.where(F.col("n").isin([*top.centres])).collect()}

    def search(these: DataFrame, same: bool) -> DataFrame:
        """Every block of a cell meets every deal of the anchors that need the cell."""
        parts = written(cells.join(these.groupBy("n", "cell").agg(F.ceil(F.count("*") / ANCHORS).alias("deals")), ["n", "cell"]).select("n", "cell", "blocks", "deals"), "cell-parts")
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        mine = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id", "label"), F.col(n))
        dealt = these.join(parts, ["n", "cell"]).withColumn("deal", mine("deals", 4)).select("*", every("blocks").alias("block")).select("n", "cell", "block", "deal", "vec_id", "hash", "label", "vector", "low", "high", "known")
        against = placed.join(parts, ["n", "cell"]).withColumn("block", mine("blocks", 3)).select("*", every("deals").alias("deal")).select("n", "cell", "block", "deal", "vec_id", "label", "vector", "ids")
        keys = ["n", "cell", "block", "deal"]
        return written(against.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(_search(norm, k, same), HITS), "hits")

    @F.pandas_udf("array<long>")
    def reached(vectors: pd.Series, low: pd.Series, high: pd.Series, home: pd.Series) -> pd.Series:
        """The cells, but for the home cell, whose bounds meet low to high."""
        out = []
        for v, a, b, h in zip(vectors, low, high, home, strict=True):
            centres = top.centres.get(len(v))
            if centres is None:
                out.append([0] if h != 0 else [])
                continue
            unit, scale = _anchor(matrix([v])[0], norm)
            held = np.array([c for c in range(len(centres)) if c != h and (len(v), c) in radius], np.int64)
            lo, hi = bounds(centres[held], np.array([radius[len(v), int(c)] for c in held]), unit, scale)
            out.append(held[(lo <= b) & (hi >= a)].tolist())
        return pd.Series(out)

    nothing = [F.lit(None).cast(f"array<{t}>").alias(c) for c, t in (("low", "long"), ("high", "long"), ("known", "double"))]
    home = written(asked.select("vec_id", "hash", "label", "vector", "n", place("vector")["cell"].alias("home")), "anchor-cells")
    # positives: the anchor's own cell, then the cells that may hold better ones
    first = search(home.withColumn("cell", F.col("home")).select("*", *nothing), True)
    found = _best(first, k).groupBy("anchor", "anchor_hash").agg(F.min("score").alias("least"), F.count("*").alias("found"))
    on = (F.col("vec_id") == F.col("anchor")) & (F.col("hash") == F.col("anchor_hash"))
    floor = F.when(F.col("found") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf")))
    others = home.join(found, on, "left").select("vec_id", "hash", "label", "vector", "n", F.explode(reached("vector", floor, F.lit(float("inf")), "home")).alias("cell"))
    positives = written(_best(first.unionByName(search(others.select("*", *nothing), True)), k).select("anchor", "anchor_hash", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # negatives: all cells that meet a window
    low = F.ceil(F.col("positive_score").cast("decimal(38,0)") * share[0] / share[1]).cast("long")
    window = F.array_sort(F.collect_list(F.struct("rank", low.alias("low"), F.col("positive_score").alias("high"))))
    windows = positives.where("positive_score >= 0").groupBy("anchor", "anchor_hash").agg(window.alias("w")).select("anchor", "anchor_hash", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    wanted = home.join(windows, on).withColumn("known", F.transform("low", lambda _: F.lit(None).cast("double")))
    to = reached("vector", F.array_min("low").cast("double"), F.array_max("high").cast("double"), F.lit(-1).cast("long"))
    negatives = _best(search(wanted.withColumn("cell", F.explode(to)), False), k).withColumn("of", F.col("place") + 1).select("anchor", "anchor_hash", "of", F.col("rank").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    p = positives.select("anchor", "anchor_hash", F.col("rank").alias("of"), "positive_id", "positive_score")
    return p.join(negatives, ["anchor", "anchor_hash", "of"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def oracle(k: int = K, share: tuple[int, int] = (80, 100)) -> str:
    """The same in DuckDB's SQL, from the scores of all rows with every anchor."""
    return f"""
    WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
        FROM e a JOIN e b ON b.vec_id <> a.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {k}),
    n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND {share[0]} * positive_score <= {share[1]} * s.score AND s.score <= positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {k}
    """
