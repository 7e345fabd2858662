"""Running sums, fills, components, closures, recruitment and seeded clusters against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from sheafline.operators import checks, graph, recruit, select


@pytest.fixture
def many_partitions(spark):
    keys = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_running_sums_of_three_million_rows(spark, many_partitions):
    n = 3_000_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("id"), F.repeat(F.lit("wide"), 5).alias("wide"))
    got = checks.running(rows, [F.col("id")], F.lit(1), "place")
    assert got.agg(F.count("*"), F.sum((F.col("place") == F.col("id") + 1).cast("int")), F.countDistinct("place")).first() == (n, n, n)


def test_running_sums_in_groups(spark, many_partitions):
    rows = spark.range(200_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("g"), F.col("id") % 500)).alias("g"), (F.col("id") % 11).alias("v"))
    got = checks.running(rows, [F.desc("id")], F.col("v"), "s", ["g"])
    from pyspark.sql import Window

    want = rows.withColumn("s", F.sum("v").over(Window.partitionBy("g").orderBy(F.desc("id"))))
    assert got.count() == 200_000
    assert got.select("id", "g", "v", "s").exceptAll(want.select("id", "g", "v", "s")).isEmpty()


def test_capped_fill_equals_one_by_one(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([None, 0, 1, 2, 7, 20, 49, 51, 90, 101, 300])) for i in range(400)]
    got = {r["i"] for r in select.capped_fill(spark.createDataFrame(rows, "g string, i int, n int"), "g", ["i"], "n", 100).where("taken").collect()}
    room, want = {}, set()
    for g, i, n in rows:
        left = room.get(g, 100)
        if (n or 0) <= left:
            want.add(i)
            room[g] = left - (n or 0)
    assert got == want
    assert select.capped_fill(spark.createDataFrame([], "g string, i int, n int"), "g", ["i"], "n", 5).count() == 0


def test_components_of_a_hub_a_long_chain_and_a_circle(spark):
    edges = [(0, i) for i in range(1, 500)] + [(1000 + i, 1001 + i) for i in range(3000)] + [(9000 + i, 9000 + (i + 1) % 7) for i in range(7)] + [(8000, 8000), (None, 3), (5, 5), (7, 3)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(500)}, **{1000 + i: 1000 for i in range(3001)}, **{9000 + i: 9000 for i in range(7)}, 8000: 8000}
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_layers(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 4), (7, 8)], "u long, v long")
    got = {r["node"]: r["layer"] for r in graph.layers(edges, spark.createDataFrame([(1,), (9,), (None,)], "node long")).collect()}
    assert got == {1: 0, 9: 0, 2: 1, 4: 1, 3: 2}


def test_closure_of_a_deep_tree(spark):
    chain = spark.createDataFrame([(i, i - 1) for i in range(1, 300)] + [(0, 0)], "node long, parent long")
    got = graph.closure(chain)
    assert got.count() == 300 * 301 // 2 and got.where("node - ancestor <> distance").isEmpty()
    for bad in ([(1, 2), (2, 3), (3, 1), (4, 1)], [(1, 2), (1, 3)]):
        with pytest.raises(ValueError):
            graph.closure(spark.createDataFrame(bad, "node long, parent long"))


def test_in_reach_equals_all_distances(spark):
    rng = np.random.default_rng(2)
    points, centres = rng.normal(size=(300, 5)), rng.normal(size=(60, 5))
    radius = np.concatenate([rng.uniform(0.01, 3, 57), [0.0, 40.0, 0.5]])
    centres[57] = points[3]
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "k int, v array<double>")
    df = spark.createDataFrame([(f"c{i}", c.tolist(), float(r)) for i, (c, r) in enumerate(zip(centres, radius, strict=True))], "c string, centre array<double>, radius double")
    got = {(r["k"], r["c"]) for r in recruit.in_reach(rows, "k", "v", df, "c").collect()}
    d = np.sqrt(((points[:, None] - centres[None]) ** 2).sum(axis=2))
    assert got == {(i, f"c{j}") for i, j in zip(*np.nonzero(d <= radius), strict=True)}
    assert recruit.in_reach(rows, "k", "v", df.limit(0), "c").collect() == []


def test_compatible_taxa(spark):
    tree = graph.closure(spark.createDataFrame([(1, None), (2, 1), (10, 2), (20, 10), (21, 10), (30, 1)], "node long, parent long"))
    pairs = spark.createDataFrame([(i, *p) for i, p in enumerate([(None, 20), (20, 20), (10, 20), (2, 20), (1, 20), (21, 20), (20, 10), (30, 20), (99, 20)])], "i int, t long, b long")
    assert {r["i"] for r in recruit.compatible(pairs, "t", "b", tree, [2]).collect()} == {0, 1, 2, 3, 6}


def kmeans(x, first, k):
    """The same k-means by hand, from rows in the order of their first component."""
    n = len(x)
    centres = x[np.lexsort((np.arange(n), first))][[int((c + 0.5) * n / k) for c in range(k)]]
    for _ in range(50):
        own = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[own == c].mean(axis=0).round(12) if (own == c).any() else centres[c] for c in range(k)])
        if (new == centres).all():
            break
        centres = new
    return ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)


def silhouette(x, own):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        mine = (own == own[i]) & (np.arange(len(x)) != i)
        if not mine.any():
            out.append(0.0)
            continue
        a, b = d[i][mine].mean(), min(d[i][own == c].mean() for c in set(own) - {own[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_seeded_clusters_equal_a_fit_by_hand(spark):
    rng = np.random.default_rng(3)
    groups = {"two": (2, 80), "three": (3, 90), "one": (1, 60), "few": (2, 15), "tiny": (2, 44)}
    rows, want = [], {}
    for g, (k, n) in groups.items():
        at = rng.integers(0, k, n) if g != "tiny" else np.array([0] * 41 + [1] * 3)
        x = at[:, None] * np.array([8.0, -6.0, 3.0]) * (1 + 0.3 * at[:, None]) + rng.normal(size=(n, 3))
        keys = np.arange(len(rows), len(rows) + n)
        rows += [(int(i), g, v.tolist()) for i, v in zip(keys, x, strict=True)]
        best, own = 0.5, np.zeros(n, int)
        for kk in range(2, min(6, n // 10) + 1):
            found = kmeans(x, x[:, 0], kk)
            if n >= 20 and len(set(found)) == kk and min(np.bincount(found)) >= 5 and (s := silhouette(x, found)) > best:
                best, own = s, found
        want |= dict(zip(keys.tolist(), own.tolist(), strict=True))
    df = spark.createDataFrame(rows, "i int, g string, x array<double>")
    got = {r["i"]: r["cluster"] for r in recruit.seeded_clusters(df.unionByName(df.limit(1).select(F.lit(-1).alias("i"), F.lit(None).cast("string").alias("g"), "x")), "g", "i").collect()}
    assert got == want and len(set(want.values())) == 3
    assert recruit.seeded_clusters(df.limit(0), "g", "i").collect() == []


def test_standardised_blocks(spark):
    x = np.random.default_rng(1).normal(size=(50, 4)) * [1, 5, 0, 2] + 3
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "i int, a double, b double, c double, d double")
    got = np.array([r["x"] for r in recruit.standardised(df, [F.col(c) for c in "abcd"], [1, 1, 2]).orderBy("i").collect()])
    s = x.std(axis=0)
    want = (x - x.mean(axis=0)) / np.where(s > 1e-9, s, 1) * [1, 1, 0.5**0.5, 0.5**0.5]
    assert np.allclose(got[:, [0, 1, 3]], want[:, [0, 1, 3]]) and np.allclose(got[:, 2], 0, atol=1e-6)


@pytest.mark.parametrize("whole", [True, False])
def test_nearest_in_blocks_equals_all_distances(spark, monkeypatch, whole):
    monkeypatch.setattr(recruit, "BLOCK", 16)
    monkeypatch.setattr(recruit, "STRIPE", 5)
    rng = np.random.default_rng(5)
    points, centres = rng.normal(size=(150, 4)) * 20, rng.normal(size=(70, 4)) * 20
    if whole:
        points, centres = points.round(), centres.round()
    centres[40:] = centres[:30]  # ties
    radius = np.concatenate([rng.uniform(1, 40, 68), [0.0, 300.0]])
    taxa, kinds = [[None, 1, 2, 3][i % 4] for i in range(150)], [1 + j % 3 for j in range(70)]
    odd = [(900, None, 1), (901, [1.0, None, 2.0, 3.0], 1), (902, [float("nan")] * 4, 1), (903, [0.0], 1)]
    rows = spark.createDataFrame([(i, p.tolist(), t) for i, (p, t) in enumerate(zip(points, taxa, strict=True))] + odd, "k int, v array<double>, t int")
    df = spark.createDataFrame([(f"c{j:02}", c.tolist(), float(r), t) for j, (c, r, t) in enumerate(zip(centres, radius, kinds, strict=True))], "c string, centre array<double>, radius double, ct int")
    d = np.sqrt(((points[:, None] - centres[None]) ** 2).sum(axis=2))
    for by, agree in ((None, None), (("t", "ct"), lambda pairs: pairs.where("t IS NULL OR t = ct"))):
        want = {}
        for i in range(150):
            near = sorted((d[i, j], f"c{j:02}") for j in range(70) if d[i, j] <= radius[j] and (not by or taxa[i] in (None, kinds[j])))
            if near:
                want[i] = (near[0][1], near[0][0], near[1][0] if len(near) > 1 else None, len(near))
        got = {r["k"]: (r["c"], r["distance"], r["next"], r["reached"]) for r in recruit.nearest(rows, "k", "v", df, "c", by, agree).collect()}
        assert got.keys() == want.keys() and len({n for *_, n in want.values()}) > 3
        for i, (name, first, second, n) in want.items():
            assert got[i][0] == name and got[i][3] == n and got[i][1:3] == pytest.approx((first, second))
    assert recruit.nearest(rows, "k", "v", df.limit(0), "c").collect() == [] and recruit.nearest(rows.limit(0), "k", "v", df, "c").collect() == []


def test_proposals_know_the_taxa_of_all_centres(spark, tmp_path):
    from sheafline.plans import recruitment

    spark.createDataFrame([(60003, [0.5, 0.25], 9)], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert [tuple(r) for r in recruitment.q242_proposals(spark, str(tmp_path)).collect()] == [(60003, 10200, 0.0)]
    assert [tuple(r) for r in recruitment.q243_recruited(spark, str(tmp_path)).collect()] == [(60003, 10200, 0.0, True)]
