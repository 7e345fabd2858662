"""Near copies and long repeats against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sheafline.llm import components, long_repeats, near_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts_with_copies(seed=1, n=60, words=140):
    rng = random.Random(seed)
    make = lambda k: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(k))
    passage = make(90)
    out = []
    for _ in range(n):
        t = make(rng.randint(1, words))
        if rng.random() < 0.3:
            t += "\n" + passage + "\n" + make(20)
        out.append(t)
        while rng.random() < 0.5:
            w = out[-1].split(" ")
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = make(1)
            out.append(" ".join(w))
    # a large group of near copies, and exact ones
    base = make(200).split(" ")
    for _ in range(300):
        w = list(base)
        w[rng.randrange(len(w))] = make(1)
        out.append(" ".join(w))
    return out + [out[0]] * 5 + ["", None, "one", "one", "é" * 500, "x" + "é" * 450, "ab" * 600, " \n"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i * 3 + 1, t, "clash") for i, t in enumerate(texts_with_copies())], "doc_id long, text string, node string").repartition(5)


def test_classes_and_links_equal_brute_force(docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    sets = {}
    for i, t in rows:
        w = WORD.findall(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links, root = defaultdict(set), {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
                x, y = sorted((top(a), top(b)))
                root[y] = x
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_copies.near_copies(docs).collect()}
    assert got == {i: (top(i), len(links[i])) for i in ids}
    kept = near_copies.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({top(i) for i in ids})


def test_prefixes_are_shortened_by_what_is_found():
    """Many links just over the threshold call for shorter prefixes, links near 1 for none."""
    low, high = {0: 1000}, {near_copies.CELLS: 1000}
    enough = lambda cells, depth: near_copies.missed(cells, depth) <= (1 - near_copies.TARGET) * sum(cells.values())
    assert enough(high, near_copies.LEVELS) and not enough(low, near_copies.LEVELS) and enough(low, near_copies.SHORTEST)
    assert near_copies.missed({}, 8) == 0


def test_trie_equals_prefix_groups(spark):
    """Nodes are in one group of the sorted tries exactly if equal prefixes connect them, over tasks too."""
    rng = random.Random(8)
    nodes = []
    for i in range(600):
        sig = bytearray()
        for _ in range(near_copies.TREES):
            sig += b"".join(bytes([0, rng.choice([1, 1, 1, 1, 1, 1, 1, 1, 1, 2, 3])]) for _ in range(near_copies.LEVELS)) if rng.random() < 0.08 else rng.randbytes(2 * near_copies.LEVELS)
        nodes.append((i * 7 + 1, bytes(sig)))
    nodes += [(10_000 + i, nodes[3][1]) for i in range(50)]
    found = near_copies.trie(spark.createDataFrame(nodes, "node long, sig binary").repartition(3)).cache()
    across = near_copies.joints(found)
    assert found.where("edge = 1").count() > 1
    for depth in (4, 6, 8):
        root = {n: n for n, _ in nodes}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        first = {}
        for n, sig in nodes:
            for t in range(near_copies.TREES):
                k = (t, sig[2 * near_copies.LEVELS * t :][: 2 * depth])
                x, y = sorted((top(first.setdefault(k, n)), top(n)))
                root[y] = x
        got = {r["node"]: r["component"] for r in near_copies.groups(found, across, depth).collect()}
        alone = {n for n, _ in nodes if sum(top(m) == top(n) for m, _ in nodes) == 1}
        before = near_copies.groups(found, across, depth + 1) if depth < near_copies.LEVELS else None
        if before is not None:
            assert got == {r["node"]: r["component"] for r in near_copies.groups(found, across, depth, before).collect()}
        assert got == {n: top(n) for n, _ in nodes if n not in alone}


def test_recall_near_the_threshold(spark):
    """Pairs of similarity just over 0.8 are found nearly all, which the first prefixes alone would not do."""
    rng = random.Random(12)
    make = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for i in range(1500):
        w = [make() for _ in range(200)]
        v = list(w)
        for k in rng.sample(range(10, 190, 12), 4):
            v[k] = make()
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    like = [len(a & b) / len(a | b) for a, b in ((set(near_copies.shingles(rows[2 * i][1]).tolist()), set(near_copies.shingles(rows[2 * i + 1][1]).tolist())) for i in range(1500))]
    want = {2 * i for i in range(1500) if like[i] >= 0.8}
    got = {r["class_id"] for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).where("n_links > 0").collect()}
    assert got <= want and len(got) >= 0.999 * len(want) and len(want) > 1000, (len(got), len(want))


def template_texts(n, links, seed=5):
    """n texts of 60 words of one template and 60 words of their own, and near copies of the first few."""
    rng = random.Random(seed)
    template = [f"t{k}" for k in range(60)]
    texts = [" ".join(template + [f"w{rng.randrange(10**7)}" for _ in range(60)]) for _ in range(n)]
    return texts + [texts[k] + " end" for k in range(links)]


def test_groups_of_a_template_are_split_without_losing_links(spark):
    texts = template_texts(90, 12) + [f"{x} more" for x in template_texts(3, 0, seed=6)] + template_texts(3, 3, seed=6)
    ids = list(range(len(texts)))
    sets = [set(near_copies.shingles(t).tolist()) for t in texts]
    links = {(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    members = spark.createDataFrame([(0, k) for k in ids] + [(-1, 1000), (-1, 1001)], "component long, node long")
    held = spark.createDataFrame([(k, t) for k, t in zip(ids, texts)] + [(1000, "a b"), (1001, "a c")], "node long, text string")
    got = near_copies.parted(held, members, split=8).collect()
    part = {r["node"]: r["part"] for r in got}
    assert all(part[a] == part[b] for a, b in links)
    # the small group stays as it is; the large one falls into parts of the size of its classes
    assert part[1000] == part[1001] == -1
    assert max(sum(p == q for q in part.values()) for p in part.values()) <= 3 and len(part) - 2 == len({x for e in links for x in e})
    nodes = spark.createDataFrame([(k, 1) for k in ids + [1000, 1001]], "node long, copies long")
    found = near_copies.verified(held, nodes, members, block=8, split=8).where("u = v AND cell < 0").groupBy("u").agg(F.sum("links").alias("n")).collect()
    assert {r["u"]: r["n"] for r in found} == {k: n for k in ids if (n := sum(k in e for e in links))}


def test_signatures_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**64, 1000, np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**64, 200, np.uint64)])
    x, y = (np.frombuffer(near_copies.signature(np.sort(v)), ">u2") for v in (a, b))
    assert abs((x == y).mean() - 800 / 1200) < 0.1


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 5001 + i) for i in range(50)]
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: top(x) for a, b in edges if a != b for x in (a, b)}


def test_survivors_with_null_and_repeated_ids(spark):
    make = lambda k, n=60: " ".join(f"w{k}x{i}" for i in range(n))
    near = make(9) + " more"
    rows = [(None, make(k)) for k in range(5)] + [(None, make(2)), (None, make(6)), (6, make(6)), (7, make(7)), (7, make(8)), (8, make(9)), (9, near), (9, make(10)), (None, make(9) + " other")]
    rows += [(None, make(11)), (None, make(11) + " more"), (None, None), (None, ""), (12, None), (12, " ")]
    docs = spark.createDataFrame([(i, t, str(k)) for k, (i, t) in enumerate(rows)], "doc_id long, text string, tag string")
    kept = near_copies.drop_near_copies(docs)
    assert kept.columns == docs.columns
    got = sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=repr)
    unnamed = [(i, t) for i, t in got if i is None and t and t.startswith("w11x0")]
    assert len(unnamed) == 1 and unnamed[0] in rows
    want = [(None, make(k)) for k in range(5)] + [(6, make(6)), (7, make(7)), (7, make(8)), (8, make(9)), (9, make(10)), (None, None), (None, ""), (12, None), (12, " ")]
    assert sorted(want + unnamed, key=repr) == got


def brute_repeats(rows, length=400):
    where = defaultdict(int)
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        for p in range(len(b) - length + 1):
            where[b[p : p + length]] += 1
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if where[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def repeats_of(df):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in long_repeats.long_repeats(df).collect())


def test_long_repeats_equal_brute_force(docs):
    assert repeats_of(docs) == brute_repeats([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_long_repeats_across_segments(spark, monkeypatch):
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    p = make(900)
    rows = [(1, make(3000) + p + make(2500)), (2, make(10) + p), (3, p[100:480]), (4, p[100:501]), (5, make(4000)), (6, "z" * 5000), (7, make(399)), (8, p[3:850] + make(5) + p[400:870])]
    monkeypatch.setattr(long_repeats, "SEGMENT", 1024)
    segs = list(long_repeats.segments(b"x" * 3000))
    assert [a for a, _ in segs] == [0, 1024, 2048] and all(len(b) >= 400 for _, b in segs)
    assert repeats_of(spark.createDataFrame(rows, "doc_id long, text string")) == brute_repeats(rows)


def brute_passages(rows, length=51):
    """Words in passages of at least so many words that another row also holds, and the spans of words."""
    data = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    where = defaultdict(set)
    for n, (_, w) in enumerate(data):
        for p in range(len(w) - length + 1):
            where[tuple(w[p : p + length])].add(n)
    out = []
    for i, w in data:
        held = bytearray(len(w))
        for p in range(len(w) - length + 1):
            if len(where[tuple(w[p : p + length])]) > 1:
                held[p : p + length] = b"\1" * length
        out.append((i, sum(held), [m.span() for m in re.finditer(b"\1+", bytes(held))]))
    return sorted(out, key=repr)


def passages_of(df):
    rows = long_repeats.long_repeats(df).collect()
    return sorted(((r["doc_id"], r["n_shared_words"], [tuple(x) for x in r["passages"] or []]) for r in rows), key=repr)


def test_passages_equal_brute_force(docs):
    got = passages_of(docs)
    assert got == brute_passages([(r["doc_id"], r["text"]) for r in docs.collect()]) and any(n for _, n, _ in got)


def test_passages_of_over_fifty_words_in_fewer_bytes_than_go(spark):
    rng = random.Random(5)
    make = lambda n: [rng.choice("abcdefghé") * rng.randint(1, 3) + rng.choice("xyz") * rng.randint(0, 9) for _ in range(n)]
    p, common, long_ = [w[:5] for w in make(51)], [w[:4] for w in make(60)], make(400)
    j = " ".join
    rows = [
        (1, j(make(300) + p + make(200))), (2, "\t\n ".join(p)), (3, j(p[:50])), (4, j(make(9) + p[1:] + make(9))),  # 50 words are not over 50
        (5, j(p[:30] + ["other"] + p[31:])), (6, j(make(80) + [w[:3] for w in p] * 3)), (7, j(common * 4)), (7, j(make(20) + common + make(20))), (None, j(make(5) + common)),
        (8, j(long_)), (8, j(long_)), (9, j(long_[:200] + make(3) + long_[200:])), (10, j(make(60))), (11, None), (12, ""), (None, j(long_[20:90] + long_[10:80])),
        (13, j(["w\0"] + ["w"] * 50)), (14, j(["w"] * 51)), (15, j(["w\0"] * 51)), (16, j(["n"] * 300)), (17, "x" * 3000 + " " + j(p)),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_passages(rows)
    assert passages_of(df) == want
    by = {i: n for i, n, _ in want}
    assert (by[1], by[2], by[3], by[4], by[5], by[6], by[13], by[16], by[17]) == (51, 51, 0, 0, 0, 0, 0, 0, 51)
    assert all(r["n_removed"] == 0 for r in long_repeats.long_repeats(df).where("doc_id IN (1, 2)").collect())


def test_words_of_long_texts_keep_their_numbers(monkeypatch):
    text = " ".join(f"word{n}" * (1 + n % 9) for n in range(500)).encode()
    ids = long_repeats.words(text)[0]
    monkeypatch.setattr(long_repeats, "SEGMENT", 100)
    assert (long_repeats._all_words(text) == ids).all()
    parts = list(long_repeats._words_together([(1, b"a b"), (2, text), (3, b"c " * 60)]))
    seen = [at + n for held, _ in parts for key, at, lo, hi in held if key == 2 for n in range(hi - lo - 50)]
    assert seen == list(range(len(ids) - 50)) and all((part == ids[at : at + len(part)]).all() for held, part in parts for key, at, *_ in held if key == 2)
    assert [k for held, _ in parts for k, *_ in held if k != 2] == [3]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near_copies.near_copies(none).count() == 0 and long_repeats.long_repeats(none).count() == 0
    nulls = spark.createDataFrame([(None, None), (1, None), (1, None)], "doc_id long, text string")
    assert near_copies.near_copies(nulls).count() == 3 and long_repeats.long_repeats(nulls).agg(F.sum("n_removed")).first()[0] == 0
