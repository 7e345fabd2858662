"""Phrase collocations against brute force."""

import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from sheafline.llm import phrases as P

SCHEMA = "text string, lang string"


def brute(rows, least, longest, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[\x20\t]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        held = {w: a for w, a in counts.items() if len(w) > 1 and a >= least}
        rows = []
        for w, a in held.items():
            longer = [x for x, b in held.items() if len(x) > len(w) and b >= a and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))]
            if longer:
                continue
            score, k = min((1000 * a * n[lang] // (counts[w[:k]] * counts[w[k:]]), k) for k in range(1, len(w)))
            rows.append((-score, -a, " ".join(w).encode(), counts[w[:k]], counts[w[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def found(spark, rows, least=4, longest=5, top=2000, **sizes):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, P.top_phrases(P.phrases(docs, least, longest, **sizes), top).collect()))


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "Of", "ÄHN", "été", "a-b", "x\x00y", "日本", "new", "york", "city", "Z"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!"]) for _ in range(rng.randrange(60)))
    rows = [(text(), rng.choice(["en", "fr", None])) for _ in range(n)]
    return rows + [(None, "en"), ("", "fr"), (" \t .,", "es"), ("new york city " * 30, "en"), ("again " * 400, "en"), ("I saw the new york city zoo in new york city. " * 9, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows, 4, 5)


def test_small_blocks_and_sub_stripes(spark):
    rows = corpus(3)
    assert found(spark, rows, block=40, chunk=25, part=6) == brute(rows, 4, 5)


def test_first_of_each_language(spark):
    rows = corpus(4)
    assert found(spark, rows, least=2, longest=3, top=7) == brute(rows, 2, 3, 7)


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None), ("", "en")]) == []
    rows = corpus(5, 40)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit(1)).withColumn("words", F.lit("x")).withColumn("doc_id", F.lit(None))
    assert sorted(map(tuple, P.top_phrases(P.phrases(docs, 4)).collect())) == brute(rows, 4, 5)


def test_products_beyond_64_bits(spark):
    given = [(3 * 10**12 + 1, 7 * 10**15 + 3, 4 * 10**12 + 7, 5 * 10**12 + 9), (10**13, 10**16, 10**13, 10**13), (100, 10**15, 100, 101)]
    rows = spark.createDataFrame([tuple(map(Decimal, x)) for x in given], "a decimal(19,0), n decimal(19,0), l decimal(19,0), r decimal(19,0)")
    got = [x[0] for x in rows.select(P.score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))).collect()]
    assert got == [1000 * a * n // (x * y) for a, n, x, y in given]


def test_word_hashes_are_sparks(spark):
    import xxhash

    words = ["", "the", "日本", "x" * 100]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()]
    assert [x % 2**64 for x in got] == [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words]
