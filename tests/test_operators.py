"""Operators against plain Python on small inputs, where the SQL comparison does not reach."""

import random
import zlib
from datetime import datetime, timedelta
from functools import lru_cache

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sheafline.functions import sequences
from sheafline.operators import binning, checks, graph, intervals, mapping, metrics, partition, pathways, report, select, taxonomy, votes
from sheafline.plans import biology, registry


def test_every_query_gives_rows_of_a_stable_schema(spark, small):
    assert set(registry.oracle_sql()) <= set(registry.queries())
    for name in ("q02_n50_l50", "q06_interval_union", "q31_unique_match", "q35_pathway_summary", "q54_spaced_selection"):
        df = registry.queries()[name](spark, small)
        assert df.columns and df.count() > 0


def test_seeded_sample_is_crc_from_17(spark):
    ids = [f"c{i}" for i in range(500)]
    got = {r["id"] for r in spark.createDataFrame([(i,) for i in ids], "id string").where(select.seeded_sample(F.col("id"), 0.3)).collect()}
    assert got == {i for i in ids if zlib.crc32(i.encode(), 17) < 0.3 * 2**32}


@pytest.mark.parametrize("n,cap", [(1, 10), (7, 3), (10, 10), (11, 10), (25, 4), (6, 1), (100, 7)])
def test_spaced(spark, n, cap):
    want = list(range(1, n + 1)) if n <= cap else [1 + (n - 1) // 2] if cap == 1 else [1 + round(i * (n - 1) / (cap - 1)) for i in range(cap)]
    assert spark.range(1).select(select.spaced(F.lit(n).cast("long"), cap).alias("x")).first()["x"] == want


def test_capped_fill_passes_over_what_does_not_fit(spark):
    rows = spark.createDataFrame([("g", 1, 60), ("g", 2, 50), ("g", 3, 30), ("g", 4, 20), ("g", 5, 10)], "g string, i int, q long")
    assert {r["i"] for r in select.capped_fill(rows, "g", ["i"], "q", 100).where("taken").collect()} == {1, 3, 5}


def brute_windows(genes, between, bp):
    out = []
    for i in range(len(genes)):
        w = [genes[i]]
        for g in genes[i + 1 :]:
            if g[0] - w[-1][0] - 1 > between or max(x[2] for x in w + [g]) - w[0][1] + 1 > bp:
                break
            w.append(g)
        if len(w) > 1 and not any({x[0] for x in w} <= {x[0] for x in o} for o in out):
            out.append(w)
    return [(w[0][0], w[-1][0], len(w)) for w in out]


def test_neighbourhoods(spark):
    rng = random.Random(5)
    rows, want = [], set()
    for c in range(25):
        at, place, genes = 0, 0, []
        for _ in range(rng.randint(1, 14)):
            at += rng.randint(1, 400)
            place += rng.choice([1, 1, 1, 2, 4])
            genes.append((place, at, at + rng.randint(10, 600)))
        rows += [(f"c{c}", *g) for g in genes]
        want |= {(f"c{c}", *w) for w in brute_windows(genes, 1, 1000)}
    df = spark.createDataFrame(rows, "contig string, place long, s long, e long")
    assert {tuple(r) for r in pathways.neighbourhoods(df, "contig", "place", "s", "e", 1, 1000).collect()} == want


def test_overlap_join_equals_all_pairs(spark):
    rng = random.Random(6)
    make = lambda n: [(rng.randrange(3), s := rng.randrange(500), s + rng.randrange(90)) for _ in range(n)]
    a, b = make(60), make(60)
    got = intervals.overlap_join(spark.createDataFrame(a, "k int, l_lo long, l_hi long"), spark.createDataFrame(b, "k int, r_lo long, r_hi long"), "k", 32).select("k", "l_lo", "l_hi", "r_lo", "r_hi")
    assert sorted(map(tuple, got.collect())) == sorted((k, s, e, t, u) for k, s, e in a for m, t, u in b if k == m and e >= t and s <= u)


def test_union_length(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 5, 8), ("a", 9, 12), ("a", 20, 20), ("b", 3, 7), ("b", 3, 7)], "g string, lo long, hi long")
    half = {r["g"]: (r["union_bp"], r["islands"]) for r in intervals.union_length(df, ["g"], "lo", "hi").collect()}
    full = {r["g"]: (r["union_bp"], r["islands"]) for r in intervals.union_length(df, ["g"], "lo", "hi", inclusive=True).collect()}
    assert half == {"a": (10, 3), "b": (4, 1)} and full == {"a": (13, 2), "b": (5, 1)}


def test_khop(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(8)], "u long, v long")
    hops = lambda seeds: {r["node"]: r["hop"] for r in graph.within_hops(chain, spark.createDataFrame([(s,) for s in seeds], "node long"), 2).collect()}
    assert hops([0]) == {0: 0, 1: 1, 2: 2} and set(hops([0, 8])) == {0, 1, 2, 6, 7, 8}


def test_end_overlaps_equal_brute_force(spark):
    seqs = {"k1": "AACCGT", "k2": "CGTTAA", "k3": "TACGGA", "k4": "CCGTAA", "k5": "NNNAAA", "k6": "GGGACG", "k7": "ACG"}
    comp = str.maketrans("ACGTN", "TGCAN")
    turn = lambda s, o: s if o == "+" else s.translate(comp)[::-1]
    flip, want = {"+": "-", "-": "+"}, set()
    for a, x in seqs.items():
        for b, y in seqs.items():
            for o in "+-":
                for p in "+-":
                    m = turn(x, o)[-3:]
                    if len(x) > 3 and len(y) > 3 and m == turn(y, p)[:3] and set(m) <= set("ACGT"):
                        want.add(min((a, o, b, p), (b, flip[p], a, flip[o])))
    got = graph.end_overlaps(spark.createDataFrame(list(seqs.items()), "id string, seq string"), 3)
    assert {tuple(r) for r in got.select("s", "so", "t", "to").collect()} == want


def test_unique_match(spark):
    q = spark.createDataFrame([("c0", "AACCGGTA"), ("c1", "TTAACCGG"), ("c2", "GGGG")], "qid string, seq string")
    seg = spark.createDataFrame([("1", "AACCGGTA"), ("2", "CCGGTTAA")], "sid string, seq string")
    got = {r["qid"]: (r["sid"], r["orient"], r["method"]) for r in graph.unique_match(q, seg).collect()}
    assert got["c0"][:2] == ("1", "+") and got["c1"][:2] == ("2", "-") and got["c2"][2] == "no_exact_segment_match"
    twice = graph.unique_match(q, seg.unionByName(spark.createDataFrame([("3", "AACCGGTA")], "sid string, seq string")))
    assert {r["qid"]: r["method"] for r in twice.collect()}["c0"] == "ambiguous_exact_sequence"


def test_votes(spark):
    hits = [("c", "o1", 100, 0, [("B", "x")]), ("c", "o1", 95, 1, [("B", "y"), ("B", "x")]), ("c", "o1", 80, 2, [("B", "z")]), ("d", "o2", 50, 3, [(None, None)])]
    df = spark.createDataFrame([(a, b, float(s), i, [{"r1": t[0], "r2": t[1]} for t in n]) for a, b, s, i, n in hits], "contig string, orf string, s double, line int, names array<struct<r1:string,r2:string>>").withColumn("s", F.col("s").cast("decimal(18,2)"))
    got = {(r["contig"], r["rank"]): (r["taxon"], r["support"]) for r in votes.rank_votes(votes.best_hits(df, "orf", "s", ["line"]), "contig", ["r1", "r2"], "names", "s", ["line"]).collect()}
    assert got == {("c", 0): ("B", 1.0), ("c", 1): ("x", round(147.5 / 195, 4)), ("d", 0): ("Unclassified", 0.0), ("d", 1): ("Unclassified", 0.0)}


def test_cascade(spark):
    rows = [("a", "D", "F1", "g1", 100), ("b", "D", "F1", "g2", 10), ("c", "D", "F1", None, 10), ("d", "D", None, None, 1), ("e", None, None, "g3", 5), ("f", None, None, None, 1)]
    df = spark.createDataFrame(rows, "c string, d string, f string, g string, bp long").withColumn("options", partition.labels(["d", "f", "g"], F.lit("organism")))
    got = {r["c"]: r["label"] for r in partition.cascade(df, "bp", 50).collect()}
    assert got == {"a": "g1", "b": "unclassified D", "c": "unclassified D", "d": "unclassified D", "e": "Unclassified", "f": "Unclassified"}


def test_nx(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(4), rng.choice([3, 5, 5, 8, 13, 40])) for _ in range(200)]
    want = {}
    for g in {g for g, _ in rows}:
        sizes, run = sorted((x for h, x in rows if h == g), reverse=True), 0
        for k, x in enumerate(sizes, 1):
            run += x
            if 2 * run >= sum(sizes):
                want[g] = (x, k)
                break
    assert {r["g"]: (r["n50"], r["l50"]) for r in metrics.nx_lx(spark.createDataFrame(rows, "g int, n long"), ["g"], "n").collect()} == want


def test_slot_matches():
    f = lambda *x: [frozenset(i.split("+")) for i in x]
    assert pathways.slot_matches(f("a", "x", "b", "c"), f("a", "b", "c")) == 3
    assert pathways.slot_matches(f("a+b", "c"), f("a", "b", "c")) == 3 and pathways.slot_matches(f("a"), f("a", "a")) == 1


def settled_by_hand(hits):
    """Statuses and call types by the rule as it is told, hit by hit."""
    state = {h["accession"]: [h["status"], h["call_type"]] for h in hits}
    stronger = []
    for h in sorted((h for h in hits if h["status"] == "accepted"), key=lambda h: (-h["margin"], -h["coverage"], h["accession"])):
        place = {p for lo, hi in h["spans"] for p in range(lo, hi + 1)}
        near, far = [], []
        for o in stronger:
            other = {p for lo, hi in o["spans"] for p in range(lo, hi + 1)}
            if state[o["accession"]][0] == "competing_hit" or o["target"] == h["target"] or len(place & other) < 0.5 * min(len(place), len(other)):
                continue
            close = o["margin"] - h["margin"] <= 0.1
            if not set(h["components"]) & set(o["components"]):
                (near if close else far).append(o)
            elif close and state[h["accession"]][1] == state[o["accession"]][1] == "specific":
                state[h["accession"]][1] = state[o["accession"]][1] = "shared_family"
        for o in [h, *near] if near else []:
            state[o["accession"]][0] = "ambiguous"
        if far and not near:
            state[h["accession"]][0] = "competing_hit"
        stronger.append(h)
    return {k: tuple(v) for k, v in state.items()}


def test_conflicts_equal_brute_force(spark):
    rng = random.Random(14)
    rows = []
    for protein in range(60):
        for k in range(rng.randint(1, 9)):
            spans = [(lo, lo + rng.randint(3, 25)) for lo in (rng.randint(1, 40) for _ in range(rng.randint(1, 3)))]
            rows.append({"protein": protein, "accession": f"a{k}", "target": f"t{rng.randrange(5)}", "call_type": rng.choice(["specific", "specific", "domain_only"]), "components": rng.sample("xyz", rng.randint(1, 2)), "margin": rng.randrange(64) / 64, "coverage": rng.randrange(4) / 4, "spans": spans, "status": rng.choice(["accepted"] * 5 + ["fragment_candidate"])})
    df = spark.createDataFrame(rows, "protein int, accession string, target string, call_type string, components array<string>, margin double, coverage double, spans array<struct<lo:long,hi:long>>, status string")
    got = {(r["protein"], r["accession"]): (r["status"], r["call_type"]) for r in pathways.resolve_hits(df, ["protein"]).collect()}
    want = {(p, a): v for p in range(60) for a, v in settled_by_hand([r for r in rows if r["protein"] == p]).items()}
    assert got == want and {v[0] for v in got.values()} == {"accepted", "ambiguous", "competing_hit", "fragment_candidate"} and "shared_family" in {v[1] for v in got.values()}


def test_operon_score_takes_the_better_orientation(spark):
    slots = [["a"], ["b"], ["c"]]
    rows = [(1, [(1, 1, ["a"]), (2, 1, ["x"]), (3, 1, ["b"]), (4, -1, ["c"])]), (2, [(1, -1, ["c"]), (2, -1, ["b"]), (5, -1, ["a"])]), (3, [(1, 1, ["a"]), (2, 1, ["x"])]), (4, [(1, 1, ["a", "b"]), (2, 1, ["c"])])]
    df = spark.createDataFrame(rows, "w int, genes array<struct<place:long,strand:int,components:array<string>>>")
    got = {r["w"]: (round(r["score"], 6), r["orientation"], r["matched_slots"], r["matched_genes"]) for r in pathways.operons(df, slots).collect()}
    assert got == {1: (round(2 / 3, 6), 1, "1;2;3", "1;3;4"), 2: (1.0, -1, "1;2;3", "5;2;1"), 4: (1.0, 1, "1;2;3", "1;1;2")}
    strict = df.sparkSession.createDataFrame([(1, [(1, 1, ["a"]), (2, -1, ["b"])]), (2, [(1, 1, ["b"]), (2, 1, ["a"])])], df.schema)
    assert [r["w"] for r in pathways.operons(strict, slots, use_strand="strict").collect()] == []
    assert [(r["w"], r["score"], r["matched_genes"]) for r in pathways.operons(strict, slots, use_order="ignore").where("orientation = 1").orderBy("w").collect()] == [(1, 1 / 3, "1;2"), (2, 2 / 3, "2;1")]


def chains_by_hand(genes, slots):
    """All ordered fillings, as (gene, slot) pairs."""

    def grow(i, j):
        yield ()
        for a in range(i, len(genes)):
            for b in range(j, len(slots)):
                if genes[a] & slots[b]:
                    for rest in grow(a + 1, b + 1):
                        yield ((a, b), *rest)
                    for c in range(b + 1, len(slots)):
                        if genes[a] & slots[c] and not slots[b] & slots[c]:
                            for rest in grow(a + 1, c + 1):
                                yield ((a, b), (a, c), *rest)

    return list(grow(0, 0))


def test_chains_are_the_longest_and_ties_go_to_late_genes(spark):
    rng = random.Random(3)
    for slots in ([["a", "b"], ["c"], ["b", "d"]], [["a"], ["b"], ["c"], ["a", "d"]]):
        sets = [frozenset(s) for s in slots]
        windows = [[frozenset(rng.sample("abcd", rng.randint(0, 2))) for _ in range(rng.randint(0, 6))] for _ in range(150)]
        rows = [(w, [(i, 1, [j for j, s in enumerate(sets) if g & s]) for i, g in enumerate(genes)]) for w, genes in enumerate(windows)]
        df = spark.createDataFrame(rows, "w int, g array<struct<place:long,strand:int,fits:array<int>>>")
        for r in df.select("w", pathways.chain(F.col("g"), slots).alias("c")).collect():
            genes, got = windows[r["w"]], tuple((x["place"], x["slot"]) for x in r["c"])
            every = chains_by_hand(genes, sets)
            most = max(map(len, every))
            # later genes first, then later slots; a second slot of a gene as early as may be
            key = lambda c: [(a, -b if k and c[k - 1][0] == a else b) for k, (a, b) in enumerate(c)]
            assert most == len(got) == slots_by_hand(genes, sets) and got == max((c for c in every if len(c) == most), key=key)


def test_borders_equal_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        s = "".join(rng.choice("AC") for _ in range(rng.randint(1, 60))).encode()
        limit = rng.randint(0, len(s))
        assert sequences.longest_border(s, limit) == max((k for k in range(limit + 1) if s[:k] == s[len(s) - k :]), default=0)
    assert len(sequences.canonical_kmers(range(256), 4)) == 136


def test_depth_and_routing(spark):
    rows = [
        ("r1", 64, "c1", 1, 30, "10M", 0), ("r1", 128 + 16, "c2", 5, 30, "4M2D4M", 0), ("r2", 64, "c1", 1, 30, "5M", 0), ("r2", 128, "c3", 1, 30, "5M", 0),
        ("r3", 64, "c1", 1, 5, "5M", 0), ("r3", 128, "c1", 1, 50, "5M", 0), ("r4", 64, "c1", 95, 50, "10M", 0), ("r4", 128, "c1", 3, 50, "5M", 0), ("r4", 256 + 64, "c2", 1, 50, "5M", 0), ("r5", 64, "c1", 1, 50, "5M", 0),
    ]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq long, cigar string, nm int")
    bins = spark.createDataFrame([("c1", "b1"), ("c2", "b1")], "contig string, bin string")
    got = {r["qname"]: (r["routing"], r["bin"]) for r in mapping.route_pairs(df, bins, strict=False).collect()}
    assert got == {"r1": ("accepted", "b1"), "r2": ("cross_bin", None), "r3": ("unmapped_or_ambiguous", None), "r4": ("accepted", "b1"), "r5": ("invalid_pair", None)}
    with pytest.raises(Exception, match="two primary records"):
        mapping.route_pairs(df, bins).collect()
    depth = {r["contig"]: (r["mean_depth"], r["covered_fraction"]) for r in mapping.depth_breadth(df, spark.createDataFrame([("c1", 100), ("c2", 10), ("c9", 5)], "contig string, length long")).collect()}
    assert depth == {"c1": (0.4, 0.16), "c2": (0.8, 0.6), "c9": (0.0, 0.0)}


def test_closure_finds_deep_trees_and_circles(spark):
    chain = spark.createDataFrame([(i, i - 1) for i in range(1, 12)] + [(0, None)], "node long, parent long")
    assert graph.closure(chain).where("node = 11").count() == 12
    with pytest.raises(ValueError, match="circle"):
        graph.closure(spark.createDataFrame([(1, 2), (2, 1)], "node long, parent long"))
    merged = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (6, 5), (4, 5)], "old long, new long")
    got = {r["taxid"]: r["current"] for r in taxonomy.resolve_merged(spark.createDataFrame([(i,) for i in range(1, 8)], "taxid long"), merged).collect()}
    assert got == {1: 3, 2: 3, 3: 3, 4: 5, 5: 5, 6: 6, 7: 7}


def test_running_sums_over_ranges(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(5)) for i in range(500)]
    got = {r["k"]: r["s"] for r in checks.running(spark.createDataFrame(rows, "k int, v int").repartition(7), [F.desc("k")], F.col("v"), "s").collect()}
    total, want = 0, {}
    for k, v in sorted(rows, reverse=True):
        total += v
        want[k] = total
    assert got == want


def test_prefilter_audits_a_seeded_share(spark):
    contigs = spark.createDataFrame([(f"c{i}", 1000, ["bacteria", "eukarya", "organelle", None][i % 4]) for i in range(400)], "contig string, length long, tiara string")
    genes = spark.createDataFrame([(f"c{i}", 1, i % 10 * 100) for i in range(400) if i % 5], "contig string, orfs long, coding_bp long")
    rows = binning.prefilter(contigs, genes, 0.6, audit=0.3).collect()
    for r in rows:
        i = int(r["contig"][1:])
        density = i % 10 / 10 if i % 5 else 0.0
        kind = ["bacteria", "eukarya", "organelle", "unknown"][i % 4]
        want = "search" if i % 4 == 0 else "skip_eukarya" if i % 4 == 1 else "search_rescued_coding_density" if density > 0.6 else f"skip_{kind}"
        assert r["decision"] == want and r["audited"] == (want.startswith("skip") and i % 5 != 0 and zlib.crc32(r["contig"].encode(), 17) < int(0.3 * 2**32))
    assert sum(r["audited"] for r in rows) > 20


def slots_by_hand(genes, slots):
    @lru_cache(None)
    def most(i, j):
        if i == len(genes) or j == len(slots):
            return 0
        out = max(most(i + 1, j), most(i, j + 1))
        if genes[i] & slots[j]:
            out = max(out, 1 + most(i + 1, j + 1), *[2 + most(i + 1, k + 1) for k in range(j + 1, len(slots)) if genes[i] & slots[k] and not slots[j] & slots[k]])
        return out

    return most(0, 0)


def test_slot_fold_equals_brute_force(spark):
    rng = random.Random(8)
    slots = [["a"], ["b", "c"], ["d"], ["a", "e"], ["f"]]
    wanted = [frozenset(s) for s in slots]
    seqs = {u: [rng.sample("abcdefxyz", rng.randint(0, 2)) for _ in range(rng.randint(1, 9))] for u in range(150)} | {None: [["x"], ["a"], ["d"]]}
    # one sequence that lies in many tasks, its slots filled far apart and backwards
    seqs[1000] = [["x"]] * 6000
    for k, c in enumerate("fedca"):
        seqs[1000][1100 * k + 50] = [c]
    rows = [(u, i, g) for u, genes in seqs.items() for i, g in enumerate(genes)]
    rng.shuffle(rows)
    got = {r["u"]: r["slots_matched"] for r in pathways.slot_fold(spark.createDataFrame(rows, "u long, i long, g array<string>"), "u", ["i"], "g", slots).collect()}
    for u, genes in seqs.items():
        sets = [frozenset(g) for g in genes]
        both = max(pathways.slot_matches(sets, wanted), pathways.slot_matches(sets[::-1], wanted))
        assert got[u] == both == (5 if u == 1000 else max(slots_by_hand(sets, wanted), slots_by_hand(sets[::-1], wanted))), u
    assert got.keys() == seqs.keys()


def test_slot_match_reads_every_event(spark, tmp_path):
    day = lambda k: datetime(2024, 1, 1) + timedelta(minutes=k)
    late = ["view"] * 14 + ["click", "purchase", "error"]
    rows = [(u * 100 + k, u, t, day(k)) for u in (1, 2) for k, t in enumerate(late if u == 1 else late[:13])]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp").write.parquet(f"{tmp_path}/events.parquet")
    assert {r["user_id"]: r["slots_matched"] for r in biology.q38_slot_match(spark, str(tmp_path)).collect()} == {1: 4, 2: 1}


def test_sequence_functions(spark):
    df = spark.createDataFrame([("ACGTN", "10M2I5=3X4S"), ("", "*"), ("GGCC", "4M")], "s string, c string")
    got = df.select(sequences.gc_percent(F.col("s")), sequences.gc_weighted(F.col("s")), sequences.aligned_bases(F.col("c")), sequences.kmer_counts(2)("s")).collect()
    assert [r[0] for r in got] == [40.0, None, 100.0] and [r[1] for r in got] == [2.5, 0.0, 4.0] and [r[2] for r in got] == [18, 0, 4]
    assert sum(got[0][3]) == 6 and got[2][3][5] == 2 and got[2][3][10] == 2  # CC and GG on both strands
    s = "ACGTA" * 2 + "T" * 30 + "ACGTA" * 2
    assert spark.createDataFrame([(s,), ("A" * 20,)], "s string").select(sequences.terminal_overlap(3, 50)("s")).collect()[0][0] == 10


def test_finest_rank():
    assert binning.finest(["domain", "genus"]) == "genus" and binning.finest(["domain", "genus"], "domain") == "domain" and binning.finest([]) is None


def test_exact_median_of_counted_values(spark):
    rng = random.Random(2)
    rows = [(g, rng.choice([None, 1, 2, 5, 9])) for g in range(6) for _ in range(rng.randint(1, 9))] + [(9, None)]
    import statistics

    got = {r["g"]: r["median"] for r in metrics.exact_median(spark.createDataFrame(rows, "g int, v int"), ["g"], "v").collect()}
    held = {g: [v for h, v in rows if h == g and v is not None] for g in range(10)}
    assert got == {g: statistics.median(v) for g, v in held.items() if v}


def test_density_of_contigs_without_genes(spark):
    contigs = spark.createDataFrame([(1, 100, 0.5, "b"), (2, 100, 0.5, "b"), (3, 100, 0.5, "b")], "contig int, length long, gc double, bin string")
    genes = spark.createDataFrame([(1, 2, 30), (2, 9, 400)], "contig int, orfs long, coding_bp long")
    cov = spark.createDataFrame([], "contig int, mean_depth double, covered_fraction double")
    table = report.feature_table(contigs, {}, cov, genes, contigs.limit(0))
    assert {tuple(r) for r in table.select("ID", "coding_density", "n_cds").collect()} == {(1, "0.3000", "2"), (2, "1.0000", "9"), (3, "NA", "NA")}
    calls = spark.createDataFrame([], "contig int, rank string, taxon string, support double")
    pre = spark.createDataFrame([], "contig int, decision string, tiara string, audited boolean")
    wide = binning.classification(contigs, calls, cov, genes, pre, spark.createDataFrame([], "contig int, why string"), ["domain"])
    assert {tuple(r) for r in wide.select("contig", "coding_density", "n_cds").collect()} == {(1, "0.30000", "2"), (2, "1.00000", "9"), (3, "NA", "NA")}


def test_equal_windows_are_judged_once(spark, monkeypatch):
    held, write = {}, pathways.written
    monkeypatch.setattr(pathways, "written", lambda df, name: held.setdefault(name, write(df, name)))
    rows = [(w, [(10 * w + 1, 1, ["a"]), (10 * w + 4, 1 - 2 * (w % 2), ["b"]), (10 * w + 4, 1, ["x"])]) for w in range(400)]
    df = spark.createDataFrame(rows, "w int, genes array<struct<place:long,strand:int,components:array<string>>>")
    got = {r["w"]: (r["score"], r["matched_slots"], r["matched_genes"]) for r in pathways.operons(df, [["a"], ["b"]]).collect()}
    assert got == {w: (1.0 - 0.5 * (w % 2), "1;2", f"{10 * w + 1};{10 * w + 4}") for w in range(400)}
    assert held["kinds"].count() == 2


def test_segments_given_twice_are_read_once_each(spark):
    contigs = spark.createDataFrame([("a", "ACGT"), ("b", "AACC"), ("c", None), ("d", "GGTT"), ("e", "ACCA")], "contig string, seq string")
    segments = spark.createDataFrame([("a", 4, "ACGT"), ("a", 5, "ACGTT"), ("b", 4, "AACG"), ("c", 9, None), ("x", 4, "AACC"), ("y", 4, None)], "segment string, length long, seq string")
    got = graph.resolve_contigs(contigs, spark.createDataFrame([], "contig string, alias string"), spark.createDataFrame([], "path string"), segments)
    assert sorted(map(str, got.collect())) == sorted(
        str(Row(contig=c, place=p, orient=o, method=m))
        for c, p, o, m in [("a", "a", "+", "source_segment_name"), ("a", None, None, "source_name_length_mismatch"), ("b", None, None, "source_name_sequence_mismatch"), ("c", "c", "+", "source_segment_name"), ("d", "x", "-", "unique_exact_sequence"), ("e", None, None, "no_exact_segment_match")]
    )


def test_sequences_have_one_letter_for_each_character(spark, tmp_path):
    from sheafline.plans import networks

    rows = [(1, "eTa oB.z,\nQ"), (2, "7ßİ\U0001f600x\ré-N"), (3, ""), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["id"]: r["seq"] for r in networks._sequences(spark, str(tmp_path)).collect()} == {1: "ACGATACCGTA", 2: "NNNNTNNNC", 3: "", 4: None}
