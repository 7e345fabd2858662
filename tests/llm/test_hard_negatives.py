"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from sheafline.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=5):
    """The same result by sorting all scores; rows: (vec_id, vector, label)."""
    fine = [(i, [int(np.floor(256 * x)) for x in v], (c + 1) % 10 if i % 7 == 0 else c) for i, v, c in rows if None not in (i, v, c) and all(x is not None and np.isfinite(x) for x in v)]
    fine = sorted({(i, tuple(v), c) for i, v, c in fine})
    out = []
    for a, q, label in fine:
        if a % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v, strict=True)), i, c) for i, v, c in fine if i != a and len(v) == len(q)))
        for p, pid, _ in [x for x in scored if x[2] == label][:k]:
            near = [x for x in scored if x[2] != label and 80 * -p <= 100 * -x[0] <= 100 * -p][:k]
            out += [(a, pid, n, i, -p, -s) for n, (s, i, _) in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows):
    return sorted(map(tuple, H.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()))


def clustered(n, size, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    return [(i, (centres[rng.integers(12)] + 0.4 * rng.normal(size=size)).tolist(), int(rng.integers(10))) for i in range(n)]


def test_equals_brute_force(spark):
    rows = clustered(1500, 12, 1)
    assert mined(spark, rows) == brute(rows)


def test_many_cells_and_blocks(spark, monkeypatch):
    for name, value in (("CELL", 60), ("BLOCK", 40), ("ANCHORS", 3), ("SAMPLE", 300)):
        monkeypatch.setattr(H, name, value)
    rows = clustered(1200, 6, 2)
    assert mined(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        *[(i, [1.0, 0.5], i % 3) for i in range(0, 40)],  # equal vectors: ties by id
        (100, None, 1), (200, [1.0, None], 1), (300, [nan, 1.0], 1), (400, [inf, 1.0], 1), (500, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
        (600, [1.0, 0.25, 0.5], 1), (601, [1.0, 0.25, 0.5], 1), (602, [1.0, 0.25, 0.25], 2), (603, [1.0, 0.25], 2),  # another length
        (700, [0.0, 0.0], 1), (701, [0.0, 0.0], 2), (800, [-1.0, -1.0], 3), (900, [], 1), (901, [], 1), (902, [], 2),
        (1000, [1.0, 0.75], 4), (1000, [1.0, 0.75], 4), (1000, [0.75, 1.0], 4), (1001, [1.0, 1.0], 4), (1002, [0.9, 0.9], 5),  # repeated ids
    ]
    assert mined(spark, rows) == brute(rows)


def test_scores_beyond_doubles(spark):
    rows = [(i, [3.0e6 + i, -1.0e6 * (i % 5), 7.0 * i], i % 4) for i in range(120)]
    assert mined(spark, rows) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    assert mined(spark, []) == []
    rows = clustered(300, 5, 3)
    given = spark.createDataFrame(rows, SCHEMA)
    more = given.withColumn("score", F.lit("x")).withColumn("anchor", F.lit(1)).withColumn("cell", F.lit(None))
    assert sorted(map(tuple, H.hard_negatives(more).collect())) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bounds_hold(seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-300, 300, size=(400, 9)).astype(float)
    norm = np.sqrt((vectors**2).sum(axis=1).max())
    tree = H.CoverTree(H.augmented(vectors, norm), fanout=4, leaf=8)

    def below(node):
        return tree.rows[node].tolist() if tree.children[node] is None else [r for c in tree.children[node] for r in below(c)]

    assert sorted(below(0)) == list(range(400))
    for q in vectors[:20]:
        low, high = tree.bounds(np.arange(len(tree.centres)), *H._anchor(q, norm))
        for node in range(len(tree.centres)):
            inside = vectors[below(node)] @ q
            assert low[node] <= inside.min() and inside.max() <= high[node]
