"""Approximate nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from sheafline.llm import neighbours


def brute(rows, k=10):
    ok = [(i, np.array(v, float)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) and i is not None]
    out = {}
    for i, v in ok:
        if i % 100 == 0:
            out[i] = sorted((math.sqrt(((v - w) ** 2).sum()), j) for j, w in ok if j != i)[:k]
    return out


def recall(got, want):
    return sum(len({v for _, v in want[q]} & {v for _, v in got.get(q, [])}) for q in want) / max(1, sum(map(len, want.values())))


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    v = rng.standard_normal((3000, 24)).astype(np.float32)
    data = [(i, [float(x) for x in v[i]]) for i in range(3000)]
    data += [(3000 + i, data[7][1]) for i in range(400)] + [(5000, None), (5100, [0.0] * 24), (5200, [float("nan")] * 24), (5300, [None] * 24)]
    return data


@pytest.mark.parametrize("cell", [50_000, 500])
def test_recall_and_ties(spark, rows, monkeypatch, cell):
    monkeypatch.setattr(neighbours, "CELL", cell)
    monkeypatch.setattr(neighbours, "QUERIES", 20)
    monkeypatch.setattr(neighbours, "BLOCK", 400 if cell == 500 else 50_000)
    got = found(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    assert set(got) == set(want) and recall(got, want) >= 0.95
    assert got[3100] == [(0.0, 7)] + [(0.0, 3000 + i) for i in range(9)]  # copies: the smallest ids
    for q in want:
        for s, v in got[q]:
            exact = dict((b, a) for a, b in brute([r for r in rows if r[0] in (q, v)], 1).get(q, []))
            assert not exact or abs(exact[v] - s) < 1e-9


def test_every_rank(spark):
    """The query's own vector takes no place among the nearest, which would loosen the last rank's bound."""
    v = np.random.default_rng(11).standard_normal((6000, 32))
    data = [(i, v[i].tolist()) for i in range(6000)]
    got, want = found(neighbours.nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>"))), brute(data)
    for rank in range(10):
        assert np.mean([want[q][rank][1] in {x for _, x in got[q]} for q in want]) >= 0.99, rank


def test_open_cells_are_those_in_reach():
    rng = np.random.default_rng(2)
    points = rng.standard_normal((400, neighbours.DIMS))
    tree = neighbours.splits(points, 16)
    at, cells = neighbours.open_cells(points[:50], tree, np.full(50, 0.5))
    own = neighbours.cell_of(points, tree)
    reached = set(zip(at.tolist(), cells.tolist(), strict=True))
    assert all((i, own[i]) in reached for i in range(50))
    near = ((points[:50, None] - points[None]) ** 2).sum(axis=2) <= 0.5
    assert all((i, own[j]) in reached for i, j in zip(*np.nonzero(near), strict=True))


def test_other_columns_and_clashing_names(spark):
    data = [(i, [float(i), 1.0], i, "x") for i in range(120)]
    got = neighbours.nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>, cell long, query string")).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got)[:3] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]


def test_table_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = found(neighbours.nearest(table))
    want = brute([(r["vec_id"], list(r["embedding"])) for r in table.collect()])
    assert recall(got, want) >= 0.95


def test_small_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(none).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["vec_id"]) for r in neighbours.nearest(two).collect()] == [(0, 1)]


def test_lengths_apart_and_repeated_ids(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(4 if i % 3 else 7).tolist()) for i in range(900)] + [(100, [9.0] * 4), (100, [9.0] * 7), (300, [1.0, 2.0]), (5, [1.0, 3.0]), (1100, [1.0])]
    got = found(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)))
    for q in (0, 100, 200, 300, 1100):
        own = min(v for i, v in rows if i == q)
        want = sorted((math.dist(own, v), i) for i, v in rows if i != q and len(v) == len(own))[:10]
        assert [i for _, i in got.get(q, [])] == [i for _, i in want], q
