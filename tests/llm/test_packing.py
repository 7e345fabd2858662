"""Packing: patterns against exhaustive search, pieces against the tokenizers library."""

import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F
from sheafline.llm import packing as P
from sheafline.llm.byte_bpe import _tokenizer, vocabulary_path

SCHEMA = "doc_id long, text string"


def fewest(items, capacity):
    """The least number of sequences, by trying every place of every piece."""
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= items[i]:
                left = list(rooms)
                left.remove(r)
                place(i + 1, [*left, r - items[i]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best


def held(patterns, capacity):
    out = {}
    for n, fill in patterns:
        assert n > 0 and sum(s * j for s, j in fill) <= capacity
        for s, j in fill:
            out[s] = out.get(s, 0) + n * j
    return out


def test_patterns_are_optimal_for_small_tables():
    rng = random.Random(5)
    for _ in range(120):
        capacity = rng.choice([10, 20, 31, 64])
        items = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 10))), reverse=True)
        counts = {s: items.count(s) for s in items}
        found = P.complete(counts, capacity)
        assert held(found, capacity) == counts
        assert sum(n for n, _ in found) == fewest(items, capacity)
        assert P.lower_bound(counts, capacity) <= fewest(items, capacity)


def test_large_histograms():
    rng = random.Random(6)
    counts = {}
    for _ in range(50_000):
        s = min(1024, max(1, int(rng.lognormvariate(5.5, 1))))
        counts[s] = counts.get(s, 0) + 1
    first, found = P.best_fit(counts, 1024), P.complete(counts, 1024)
    assert held(first, 1024) == held(found, 1024) == counts
    assert P.lower_bound(counts, 1024) <= sum(n for n, _ in found) <= sum(n for n, _ in first)
    assert sum(n for n, _ in found) <= 1.001 * P.lower_bound(counts, 1024)
    huge = {s: n * 10**9 for s, n in counts.items()}
    assert held(P.complete(huge, 1024), 1024) == huge
    assert P.complete({}, 1024) == []


def test_best_fit_equals_one_by_one():
    rng = random.Random(7)
    for _ in range(30):
        items = sorted((rng.randrange(1, 60) for _ in range(200)), reverse=True)
        rooms = []
        for s in items:
            fit = [r for r in rooms if r >= s]
            if fit:
                rooms.remove(min(fit))
            rooms.append((min(fit) if fit else 60) - s)
        assert sum(n for n, _ in P.best_fit({s: items.count(s) for s in items}, 60)) == len(rooms)


@lru_cache
def ids(text):
    return [*_tokenizer(vocabulary_path()).encode(text or "", add_special_tokens=False).ids, 2]


def examine(rows, got, capacity=1024):
    """Pieces are those of the documents, sequences are gapless and not too long."""
    want = []
    for doc, text in rows:
        x = ids(text)
        cuts = [0, *range((len(x) - 1) % capacity + 1, len(x) + 1, capacity)]
        want += [(doc, k, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted((r[:5] for r in got), key=key) == sorted(want, key=key)
    inside = {}
    for r in got:
        inside.setdefault(r[5], []).append((r[6], r[3]))
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(inside)


def documents(n, seed=3):
    rng = random.Random(seed)
    words = ["one", "Élan", "naïve", "日本語", "x9", "don't", "<|endoftext|>", "\t", "🙂", "....", "\n\n"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(int(rng.lognormvariate(4, 1.3))))) for i in range(n)]
    return rows + [(None, None), (None, ""), (7, ""), (7, ""), (n, "a" * 30_000), (n + 1, " " * 5_000), (n + 2, "word " * 30_000), (n + 3, "tie"), (n + 4, "tie")]


def test_pack(spark):
    rows = documents(300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumn("piece", F.lit("x")).withColumn("k", F.lit(None)).withColumn("n", F.lit(1))
    packed = P.pack(df)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    n = examine(rows, [tuple(r) for r in packed.collect()])
    counts = {}
    for _, text in rows:
        x = len(ids(text))
        counts[(x - 1) % 1024 + 1] = counts.get((x - 1) % 1024 + 1, 0) + 1
        counts[1024] = counts.get(1024, 0) + (x - 1) // 1024
    assert n <= P.lower_bound(counts, 1024) + 1


def test_sequences_hold_the_documents(spark):
    rows = documents(60, 4)
    df = spark.createDataFrame([r for r in rows if r[0] is not None and r[0] != 7], SCHEMA)
    made = P.sequences(P.pack(df, capacity=128, with_ids=True)).collect()
    parts = {}
    for r in made:
        assert len(r["ids"]) <= 128
        for p in r["pieces"]:
            parts.setdefault(p["doc_id"], {})[p["piece"]] = r["ids"][p["offset"] : p["offset"] + p["length"]]
    for doc, text in rows:
        if doc is not None and doc != 7:
            assert [x for k in sorted(parts[doc]) for x in parts[doc][k]] == ids(text)


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ids_equal_the_tokenizers_library(seed):
    rng = random.Random(seed)
    kinds = [lambda: chr(rng.randrange(32, 127)), lambda: rng.choice(" \t\n\r  　"), lambda: chr(rng.choice([*range(0xA0, 0xD7FF), *range(0xE000, 0x20000)])), lambda: rng.choice(["'s", "'LL", "’re", "12", "..."])]
    for _ in range(300):
        text = "".join(rng.choice(kinds)() for _ in range(rng.randrange(80)))
        assert P.encode(text, vocabulary_path()).tolist() == ids(text)[:-1]
    for text in ("a" * 5000, " " * 5000, "ab " * 3000, "\n" * 4000 + "x"):
        assert P.encode(text, vocabulary_path()).tolist() == ids(text)[:-1]
