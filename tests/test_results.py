"""Graph files, result sets, feature sets, trees, cached votes, layouts of runs and logs."""

import json

import pytest
from pyspark.sql import functions as F
from sheafline.operators import features, results, trees, votes
from sheafline.sources import discovery, graphs
from sheafline.streaming import logs

GFA = ["H\tVN:Z:1.0", "S\ta\tacgt\tdp:f:2.5\tKC:i:12", "S\tb\t*\tLN:i:7\tDP:f:-1", "# note", "", "L\ta\t+\tb\t-\t2M", "J\tb\t+\ta\t+\t*", "P\tp\ta+,b-\t*", "W\ts\t1\tq\t0\t9\t>a<b>a", "X\todd"]


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_graph_records_round_trip(spark, tmp_path):
    got = graphs.graph(spark, write(tmp_path / "g.gfa", GFA))
    assert sorted(map(tuple, got["segments"].collect())) == [("a", "ACGT", 4, 2.5, 12, None), ("b", None, 7, None, None, None)]
    assert sorted(map(tuple, got["links"].collect())) == [("a", "+", "b", "-", "2M", "L"), ("b", "+", "a", "+", "*", "J")]
    assert got["unsupported"].first()[0] == 1
    at = sorted(map(tuple, graphs.step_offsets(got["path_steps"], got["segments"]).collect()))
    assert at == [("p", 0, "a", "+", 0, 4), ("p", 1, "b", "-", 4, 11), ("s#1#q#0#9", 0, "a", "+", 0, 4), ("s#1#q#0#9", 1, "b", "-", 4, 11), ("s#1#q#0#9", 2, "a", "+", 11, 15)]


@pytest.mark.parametrize(
    ("line", "said"),
    [
        ("H\tVN:Z:2.0", "bad.gfa:11: a GFA2 file"), ("S\tc\t100\tACGT", "bad.gfa:11: a GFA2 segment"), ("S\ta\tAC", "bad.gfa:11: segment given twice: a"), ("L\ta\t+\tb\tx\t*", "bad.gfa:11: a malformed link"),
        ("L\ta\t+\tz\t+\t*", "bad.gfa:11: a link to an absent segment: z"), ("P\tr\ta+,b\t*", "bad.gfa:11: a malformed path"), ("P\tr\ta+,z-\t*", "bad.gfa:11: a path over an absent segment: z"),
        ("W\ts\t1\tq\t0\t9\t>a", "bad.gfa:11: path given twice"), ("W\ts\t1\tr\t0\t9\ta>b", "bad.gfa:11: a malformed walk"), ("S\tc", "bad.gfa:11: a segment without"),
    ],
)
def test_graph_problems_name_file_and_line(spark, tmp_path, line, said):
    with pytest.raises(ValueError, match=said):
        graphs.graph(spark, write(tmp_path / "bad.gfa", [*GFA, line]))


def test_graph_limits(spark, tmp_path):
    with pytest.raises(ValueError, match="no segments"):
        graphs.graph(spark, write(tmp_path / "e.gfa", ["H\tVN:Z:1.0"]))
    with pytest.raises(ValueError, match="more segments"):
        graphs.graph(spark, write(tmp_path / "g.gfa", GFA), most_segments=1)


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    path = write(tmp_path / "long.txt", [f"{i:06d}" + "x" * 90 for i in range(1, 20_001)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        got = graphs.numbered_lines(spark, path)
        assert got.where("cast(left(value, 6) AS int) = line").count() == got.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def result_set(spark, **changed):
    rows = {
        "bins": ([("a", "done"), ("b", "failed"), ("c", "done")], "bin_id string, status string"),
        "definitions": ([("p", "k")], "pathway string, component string"),
        "summary": ([("a", "p", "50"), ("b", "p", "60"), ("c", "p", "NA"), ("c", "q", "nan")], "bin_id string, pathway string, panel_percent string"),
        "hits": ([("a", "x", "accepted", "specific"), ("a", "x", "accepted", "family"), ("b", "y", "accepted", "specific")], "bin_id string, protein string, status string, target_call string"),
        "components": ([("a", "k"), ("b", "k")], "bin_id string, component string"), "neighborhoods": ([("a",)], "bin_id string"), "operons": ([], "bin_id string"),
    }
    return {n: spark.createDataFrame(changed.get(n, r), s) for n, (r, s) in rows.items()}


def test_faults_of_a_result_set(spark):
    found, counts = results.faults(result_set(spark))
    assert found.collect() == [] and counts == {"bins": 3, "definitions": 1, "summary": 4, "hits": 3, "components": 2, "neighborhoods": 1, "operons": 0}
    bad = result_set(spark, bins=[("a", "done"), ("a", "done")], summary=[("a", "p", "101"), ("a", "p", "-0.5"), ("z", "p", "3")], components=[("a", "k"), (None, "k")], operons=[("y",), ("y",)])
    got = {tuple(r) for r in results.faults(bad)[0].collect()}
    assert got == {
        ("bins", "a", "given more than once", 2), ("summary", "a/p", "given more than once", 2), ("summary", "a/p", "percentage outside 0-100", 2), ("summary", "z", "unknown bin", 1),
        ("components", "", "unknown bin", 1), ("operons", "y", "unknown bin", 2), ("hits", "b", "unknown bin", 1),
    }
    with pytest.raises(ValueError, match="hits lacks target_call"):
        results.faults(result_set(spark) | {"hits": spark.createDataFrame([], "bin_id string, protein string, status string")})


def test_shown_hides_what_is_not_trusted(spark):
    tables = result_set(spark)
    digests = lambda rows: spark.createDataFrame(rows, "bin_id string, digest string")
    states = results.bin_states(tables["bins"], digests([("a", "1"), ("b", "1"), ("c", "1")]), digests([("a", "1"), ("b", "1"), ("c", "2")]))
    got = results.shown(tables, states)
    assert {(r["bin_id"], r["pathway"], r["panel_percent"], r["panel_status"]) for r in got["summary"].collect()} == {("a", "p", 50.0, None), ("b", "p", None, "bin_failed"), ("c", "p", None, "stale_input"), ("c", "q", None, "stale_input")}
    assert {tuple(r) for r in got["bins"].select("bin_id", "source_state", "accepted_models", "accepted_proteins", "review_hits").collect()} == {("a", "current", 2, 1, 1), ("b", "current", 0, 0, 0), ("c", "stale_input", 0, 0, 0)}
    assert got["hits"].count() == 2 and got["components"].count() == 1


def test_feature_sets_take_the_best_source(spark):
    records = {
        "j": {"features": [{"type": "cds", "sequence": {"id": "c1"}, "locus_tag": "L1", "product": "Hypothetical protein X", "pseudogene": {"reason": "short"}, "db_xrefs": ["a", 1], "end": 9}, {"type": "CDS", "contig": "c1", "id": "L2", "product": "kinase", "hypothetical": "no", "pseudo": "yes", "aa": "MK**"}, {"type": "tRNA", "sequence_id": "c1"}]},
        "bad": {"features": [{"contig": "c9"}, 5]}, "out": {"features": [{"contig": "c1"}, {"contig": "c2"}]}, "none": {"features": "x"},
    }
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    json_ = df([(b, json.dumps(x)) for b, x in records.items()] + [("cut", '{"features":[{')], "bin string, json string")
    table = df([("t", 2, None, "L1", "g", "hypothetical protein", "cds", "c", "1", "2", "+", ""), ("j", 2, None, "L9", "", "", "cds", "c", "1", "2", "+", ""), ("w", 2, "other", "L1", "", "", "", "", "", "", "", "")], "bin string, number long, own_bin string, locus string, gene string, product string, kind string, contig string, start string, stop string, strand string, refs string")
    seqs = df([("j", "L1", "aa", "MMM*"), ("j", "L2", "aa", "XX"), ("t", "L1", "nt", "ACGT")], "bin string, locus string, field string, seq string")
    bins = df([(b,) for b in (*records, "cut", "t", "w", "empty")], "bin string")
    made, per = features.feature_sets(bins, json_, table, seqs, df([("j", "c1"), ("out", "c1")], "bin string, contig string"))
    assert {r["bin"]: (r["source"], r["features"], r["error"]) for r in per.collect()} == {
        "j": ("json", 3, ""), "bad": ("json", 0, "feature 2 is not an object"), "out": ("json", 0, "feature 2 is on a contig outside the bin: c2"), "none": ("json", 0, "no features array"), "cut": ("json", 0, "no features array"),
        "t": ("table", 1, ""), "w": ("table", 0, "row 2 belongs to a different bin"), "empty": ("none", 0, ""),
    }
    got = {(r["bin"], r["number"]): r for r in made.collect()}
    one, two, three = got["j", 1], got["j", 2], got["j", 3]
    assert (one["contig"], one["locus"], one["hypothetical"], one["pseudogene"], one["pseudogene_note"], one["refs"], one["stop"], one["aa"], one["aa_length"]) == ("c1", "L1", True, True, "short", "a;1", "9", "MMM*", 3)
    assert (two["hypothetical"], two["pseudogene"], two["aa"], two["aa_length"]) == (False, True, "MK**", 2)
    assert (three["contig"], three["hypothetical"], three["pseudogene"], three["aa_length"]) == ("c1", None, False, None)
    assert (got["t", 2]["hypothetical"], got["t", 2]["pseudogene"], got["t", 2]["nt_length"]) == (True, None, 4)


def by_hand(text):
    """(label, parent's label, length) of a tree's nodes, by recursion."""
    at = 0

    def node(up):
        nonlocal at
        own = []
        if text[at] == "(":
            while text[at] in "(,":
                at += 1
                own.append(node(up))
            at += 1
        start = at
        while at < len(text) and text[at] not in ",();:":
            at += 1
        label, length = text[start:at] or None, None
        if at < len(text) and text[at] == ":":
            start = at = at + 1
            while at < len(text) and text[at] not in ",();":
                at += 1
            length = float(text[start:at])
        return label, length, own

    out = []

    def walk(n, up):
        out.append((n[0], up, n[1]))
        for x in n[2]:
            walk(x, n[0])

    walk(node(None), None)
    return sorted(out, key=str)


def test_trees_equal_recursion(spark):
    deep = "(" * 60 + "x" + "".join(f")n{i}:1" for i in range(60)) + ";"
    wide = "(" + ",".join(f"(a{i}:1,b{i})m{i}:0.5" for i in range(3000)) + ")root;"
    texts = {"s": "((a:1,bc:2)x:0.5,d)r;", "one": "leaf;", "deep": deep, "wide": wide, "rest": "(a,b)c; (x"}
    n = trees.nodes(spark.createDataFrame([*texts.items(), ("null", None), ("empty", "")], "t string, text string"), "t", "text")
    up = n.select(F.col("t").alias("_t"), F.col("node").alias("parent"), F.col("label").alias("up"))
    got = {}
    for r in n.join(up, (n["t"] == up["_t"]) & (n["parent"] == up["parent"]), "left").select("t", "label", "up", "length").collect():
        got.setdefault(r["t"], []).append((r["label"], r["up"], r["length"]))
    assert {t: sorted(x, key=str) for t, x in got.items()} == {t: by_hand(x) for t, x in texts.items()}
    quoted = trees.nodes(spark.createDataFrame([(1, "('it''s (a):b':-2,'');")], "t int, text string"), "t", "text")
    assert {(r["label"], r["length"], r["leaf"]) for r in quoted.collect()} == {("it's (a):b", 0.0, True), ("", None, True), (None, None, False)}
    for bad in ("((a,b);", "(a,b));"):
        with pytest.raises(ValueError, match="bracket"):
            trees.nodes(spark.createDataFrame([(1, bad)], "t int, text string"), "t", "text")


def test_cached_votes_vote_only_on_what_changed(spark):
    schema = "contig string, score decimal(18,2), o int, names array<struct<a:string>>"
    from decimal import Decimal

    hit = lambda c, s, o, n: (c, Decimal(s), o, [(n,)])
    old = [hit("x", 5, 1, "p"), hit("x", 7, 2, "q"), hit("y", 1, 1, "p"), hit("gone", 1, 1, "p")]
    new = [hit("x", 7, 2, "q"), hit("x", 5, 1, "p"), hit("y", 1, 1, "r"), hit("fresh", 1, 1, "p"), hit(None, 1, 1, "p")]
    vote = lambda h: votes.rank_votes(h, "contig", ["a"], "names", "score", ["o"])
    cache, all_ = votes.cached_votes(spark.createDataFrame(old, schema), "contig", vote)
    assert all_.count() == 3
    now, changed = votes.cached_votes(spark.createDataFrame(new, schema), "contig", vote, cache)
    assert {r["contig"] for r in changed.collect()} == {"y", "fresh"}
    assert sorted(map(tuple, now.drop("fingerprint").collect())) == sorted(map(tuple, vote(spark.createDataFrame(new[:-1], schema)).collect()))


def test_layouts_of_runs(spark, tmp_path):
    for name in ("r1/bins/genus/a.fasta", "r1/final/bins/genus/a.fasta", "r1/final/bins/genus/b.fasta", "r1/final/annotation/genus/a/features.tsv", "r1/final/classification/contig_classification.tsv", "r2/bins/genus/c.fasta", "r2/final/classification/bin_refinement.tsv", "r2/notes.txt", "r2/megahit/intermediate_contigs/k21.contigs.fa", "r2/megahit/intermediate_contigs/k99.contigs.fa", "r2/megahit/intermediate_contigs/k21.final.contigs.fa", "refs/g1.fna", "refs/g2.fa.gz"):
        p = tmp_path / "runs" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(name)
    found = discovery.files(spark, str(tmp_path / "runs"), digests=True)
    assert found.where("sha256 = sha2(concat(run, '/', path), 256)").count() == 13
    known = discovery.preferred(discovery.parts(found))
    assert {(r["run"], r["stage"], r["part"], r["rank"], r["name"]) for r in known.collect()} == {("r1", "final", "bin", "genus", "a"), ("r1", "final", "bin", "genus", "b"), ("r1", "final", "features", "genus", "a"), ("r1", "final", "classification", None, None), ("r2", "preliminary", "bin", "genus", "c")}
    assert {tuple(r) for r in discovery.missing(known).where("run = 'r1'").collect()} == {("r1", "refinement", None, None), ("r1", "feature_table", None, None), ("r1", "annotation", "genus", "b")}
    assert {(r["k"], r["chosen"], "final" in r["path"]) for r in discovery.assembler_rounds(found).collect()} == {(21, False, False), (99, True, False), (21, True, True)}
    meta = spark.createDataFrame([("g1", "Bacillus")], "name string, taxon string")
    assert {(r["name"], r["taxon"]) for r in discovery.genomes(found.where("run = 'refs'"), meta).collect()} == {("g1", "Bacillus"), ("g2", None)}
    assert {(r["part"], r["runs"], r["files"], r["final_runs"]) for r in discovery.tasks(known).where("part = 'bin'").collect()} == {("bin", 2, 3, 1)}


def test_logs_in_any_order_of_arrival(spark, tmp_path):
    rows = [{"k": i % 3, "t": (i * 7) % 20, "v": i} for i in range(20)]
    out, path = str(tmp_path / "out"), tmp_path / "logs"
    path.mkdir()
    for part in range(2):
        lines = [json.dumps(r) for r in rows[part::2]] + ['{"k": 1, "t": 99', "[1]", '{"k": 2}', ""]
        (path / f"{part}.txt").write_text("\n".join(lines))
        for q in logs.follow(spark, str(path), out, "k int, t int, v int", ["k"], ["t", "v"]):
            q.awaitTermination()
    want = {k: max((r["t"], r["v"]) for r in rows if r["k"] == k) for k in range(3)}
    assert {r["k"]: (r["t"], r["v"]) for r in logs.current(spark, out).collect()} == want
    assert sorted(r["value"] for r in spark.read.parquet(f"{out}/aside").collect()) == sorted(['{"k": 1, "t": 99', "[1]", '{"k": 2}'] * 2)
