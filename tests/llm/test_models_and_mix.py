"""The toxicity model and the mixture."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sheafline.llm import mixing, toxicity
from sheafline.llm import queries as Q


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = Q.queries()["op5_toxicity"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out AND toxic IS NOT NULL")
    r = got.agg(F.sum("toxic").alias("p"), F.sum(F.col("toxic") * F.col("predicted")).alias("tp"), F.sum((1 - F.col("toxic")) * F.col("predicted")).alias("fp")).first()
    assert r["tp"] >= 0.9 * r["p"] and r["fp"] <= 0.05 * r["tp"]  # some labels of that table have no word to show for them


def test_swapped_terms_score_alike():
    rows = [(f"the {g} people are a stupid idiot crowd number {i}", 1) for i, g in enumerate(["muslim", "gay"] * 40)]
    rows += [(f"the {g} people met for lunch number {i}", 0) for i, g in enumerate(["christian", "white"] * 40)]
    free = toxicity.fit(rows, counterfactual=0.0).score("the muslim people")
    held = toxicity.fit(rows, counterfactual=30.0)
    assert held.score("the muslim people") < free
    assert abs(held.score("the muslim people") - held.score("the christian people")) < 0.1
    assert held.score("stupid idiot crowd") > 0.7


def test_train_equals_fit_in_one_process(spark):
    """Spark's counts and rows give the model that plain Python fits on the same documents."""
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    rows = docs.join(labels.where("toxic IS NOT NULL"), "doc_id").where(~toxicity.held_out(F.col("doc_id"))).orderBy("doc_id").collect()
    plain = toxicity.fit([(r["text"] or "", r["toxic"]) for r in rows])
    assert model.weights.keys() == plain.weights.keys() and len(model.weights) > 20
    assert max(abs(w - plain.weights[f]) for f, w in model.weights.items()) < 1e-6 and abs(model.bias - plain.bias) < 1e-6
    for r in rows[:50]:
        assert abs(model.score(r["text"] or "") - plain.score(r["text"] or "")) < 1e-6


def test_neutral_mentions_are_no_longer_flagged():
    """Where abuse is often aimed at some groups, the penalty lowers the false positives on neutral mentions of them."""
    import random

    rng = random.Random(6)
    calm = "met for lunch in the old town and talked about music food and the long summer".split()
    rude = "stupid idiot filth scum".split()
    make = lambda g, bad: " ".join(rng.sample(calm, 6) + [g, "people"] + (rng.sample(rude, 1) if bad and rng.random() < 0.7 else []) + rng.sample(calm, 5))
    aimed, others = ["muslim", "gay", "immigrant"], ["christian", "white", "young"]
    rows = [(make(rng.choice(aimed), True), 1) for _ in range(300)] + [(make(rng.choice(others if rng.random() < 0.9 else aimed), False), 0) for _ in range(300)]
    neutral = [make(g, False) for g in aimed for _ in range(60)]
    flagged = lambda m: sum(m.score(t) >= toxicity.THRESHOLD for t in neutral)
    plain, held = toxicity.fit(rows, counterfactual=0.0), toxicity.fit(rows)
    assert flagged(plain) >= 30 and flagged(held) <= flagged(plain) / 3
    assert sum(held.score(t) >= toxicity.THRESHOLD for t, y in rows if y and any(w in t.split() for w in rude)) >= 150


def test_every_mention_of_a_long_text_is_swapped():
    terms = ("women", "men", "young", "old", "poor", "rich")
    text = "Women spoke. " * 300 + "The poor left! Men and women stayed?"
    got = toxicity.swaps(text, terms)
    assert got["women", "men"] == 301 and got["poor", "rich"] == 1 and got["men", "young"] == 1
    assert sum(got.values()) == (301 + 1 + 1) * 2  # of six terms, one and five places on


def test_one_label_or_none():
    assert toxicity.fit([]).score("anything") == 0.5
    assert 0 <= toxicity.fit([("a", 1), ("b", 1)]).score("") <= 1


def test_awkward_rows_are_scored(spark, small):
    model = toxicity.Model({"bad": 5.0}, -2.0)
    docs = spark.createDataFrame([(1, None, "c"), (None, "bad", "c"), (2, "", "c"), (2, "", "c")], "doc_id long, text string, score string")
    got = sorted([(r["doc_id"] or 0, round(r["score"], 3), r["predicted"], r["held_out"]) for r in toxicity.score_texts(docs, model).collect()])
    assert [g[1] for g in got] == [0.953, 0.119, 0.119, 0.119] and got[0][2:] == (1, False)
    assert toxicity.drop_toxic(docs, model).count() == 3


def water(sizes, share=1.5):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    done, left, free = {}, share * sum(sizes.values()), set(order)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return done | {s: left * weight[s] / total for s in free}
        for s in over:
            done[s] = 2.0 * sizes[s]
            free.discard(s)
        left = share * sum(sizes.values()) - sum(done.values())
    return done


@pytest.fixture(scope="module")
def sources(spark):
    rows = [(i, "w " * (i % 37), ["a", "b", None, "é", "zz"][i % 5] if i % 3 else "a") for i in range(900)] + [(7, "w " * 7, "a")] * 3 + [(None, "x y", "b"), (5000, None, "only")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("_size", F.lit("clash"))


def test_targets_and_takes(spark, sources):
    sizes, plan, _ = mixing.prepare(sources)
    got = mixing.draw(sizes, plan).collect()
    per, taken = defaultdict(int), defaultdict(int)
    for r in got:
        per[r["source"]] += r["_size"]
        taken[r["source"]] += r["_taken"]
        assert 0 <= r["_taken"] <= 2 * r["_size"] and r["_taken"] == sum(d["words"] for d in r["_draws"])
        assert all(0 <= d["shard"] < mixing.SHARDS for d in r["_draws"])
    aims = water(per)
    assert len(got) == sources.count()
    for r in got:
        assert abs(r["_target"] - aims[r["source"]]) < 1e-6 and r["_source_size"] == per[r["source"]]
    for s, want in aims.items():
        assert abs(taken[s] - want) <= 0.5
    again = mixing.draw(*mixing.prepare(sources)[:2]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_shard_quotas_are_exact(spark):
    items = spark.createDataFrame([(0, 4096), (1, 17), (2, 1), (3, 900)], "place int, n long")
    got = mixing.quotas(items, 16, 3).collect()
    per, by = defaultdict(int), defaultdict(int)
    for r in got:
        per[r["place"]] += r["last"] - r["first"]
        by[r["shard"]] += r["last"] - r["first"]
    assert per == {0: 4096, 1: 17, 2: 1, 3: 900} and max(by.values()) - min(by.values()) <= 2


def test_hypergeometric_mean(spark):
    sql = mixing._hypergeometric("1000L", "300L", "200L", "(pmod(xxhash64(id), 1000003L) / 1000003D)")
    r = spark.range(3000).select(F.expr(sql).alias("x")).agg(F.avg("x"), F.stddev("x"), F.min("x"), F.max("x")).first()
    assert abs(r[0] - 60) < 0.6 and abs(r[1] - 5.797) < 0.4 and r[2] >= 0 and r[3] <= 200


def test_mixture_rows_hold_the_words_taken(spark, sources):
    clash = sources
    for name in ("_hash", "_block", "_draws", "shard", "place", "row", "_plan_source", "words", "a.b"):
        clash = clash.withColumn(name, F.lit(name))
    mixed = mixing.mixture(clash)
    assert mixed.columns == clash.columns and mixed.where("_size <> 'clash' OR shard <> 'shard' OR `a.b` <> 'a.b'").isEmpty()
    words = mixed.select(F.sum(F.size(F.expr("filter(split(text, ' '), w -> w != '')"))).alias("n")).first()["n"]
    drawn = mixing.drawn(clash)
    assert drawn.count() == clash.count() and words == drawn.agg(F.sum("taken")).first()[0]


def test_the_tree_places_every_copy(spark, sources):
    """Shards hold what the quotas say, each shard in the order of its places, and another tree gives other shards."""
    sizes, plan, _ = mixing.prepare(sources, 32)
    one = mixing.placed(sources, 32).select("row.doc_id", "row.text", "shard", "place").collect()
    assert len(one) == sum(len(r["_draws"]) for r in mixing.draw(sizes, plan).collect()) and {r["shard"] for r in one} <= set(range(32))
    where = lambda rows: sorted((r["doc_id"] or -1, r["shard"]) for r in rows)
    other = mixing.placed(sources, 32, seed=8).select("row.doc_id", "shard").collect()
    assert where(one) != where(other)
    order = [r["shard"] for r in mixing.placed(sources, 32).repartition("shard").sortWithinPartitions("shard", "place").select("shard").collect()]
    assert sum(a != b for a, b in zip(order, order[1:], strict=False)) == len(set(order)) - 1
