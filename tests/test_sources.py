"""Readers, writers and the streaming form."""

import gzip

from pyspark.sql import functions as F

from sheafline.sources import graphs, records, sinks
from sheafline.streaming import windows


def test_fasta_round_trip(spark, tmp_path):
    with gzip.open(tmp_path / "a.fa.gz", "wt") as f:
        f.write(">c1 first one\nacgt\nACGT\n>c2\n\n>c3 x\nNN\n")
    got = sorted((r["id"], r["header"], r["seq"]) for r in records.fasta(spark, str(tmp_path / "a.fa.gz")).collect())
    assert got == [("c1", "c1 first one", "ACGTACGT"), ("c2", "c2", ""), ("c3", "c3 x", "NN")]
    seqs = spark.createDataFrame([("c1", "A" * 150), ("c2", "ACG")], "id string, seq string")
    sinks.write_fasta(seqs, str(tmp_path / "out"))
    assert {r["id"]: r["seq"] for r in records.fasta(spark, str(tmp_path / "out")).collect()} == {"c1": "A" * 150, "c2": "ACG"}
    assert records.duplicates(seqs.unionByName(seqs)).count() == 2


def test_gfa(spark, tmp_path):
    (tmp_path / "g.gfa").write_text("H\tVN:Z:1.0\nS\ta\tACGT\tRC:i:40\tKC:i:60\nS\tb\tGG\nL\ta\t+\tb\t-\t*\nL\tb\t+\ta\t-\t*\nP\tp\ta+,b-\t*\nW\tsample\t0\tchr1\t0\t4\t>a<b\n")
    g = graphs.graph(spark, str(tmp_path / "g.gfa"))
    assert g["segments"].count() == 2 and g["links"].count() == 2 and g["unsupported"].first()[0] == 0
    steps = sorted((r["path"], r["i"], r["segment"], r["orient"]) for r in g["path_steps"].collect())
    assert steps == [("p", 0, "a", "+"), ("p", 1, "b", "-"), ("sample#0#chr1#0#4", 0, "a", "+"), ("sample#0#chr1#0#4", 1, "b", "-")]
    lines = [r["value"] for r in sinks.gfa_lines(g["segments"], g["links"], 5).collect()]
    assert lines[0].startswith("H") and len(lines) == 5


def test_tables(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("o1\ts\t90\t10\t1e-5\t50\t562\no1\tbad\no2\ts\t90\t10\t1e-5\tx\t1\n")
    assert [r["malformed"] for r in records.hits(spark, str(tmp_path / "h.tsv")).orderBy("line").collect()] == [False, True, True]
    (tmp_path / "n").write_text("1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tdomain\t|\n")
    (tmp_path / "m").write_text("2\t|\tBacteria\t|\t\t|\tscientific name\t|\n2\t|\teubacteria\t|\t\t|\tsynonym\t|\n")
    (tmp_path / "x").write_text("9\t|\t2\t|\n")
    nodes, names, merged = records.taxdump(spark, str(tmp_path / "n"), str(tmp_path / "m"), str(tmp_path / "x"))
    assert nodes.count() == 2 and names.collect()[0]["name"] == "Bacteria" and merged.collect()[0]["new"] == 2
    (tmp_path / "s.sam").write_text("@SQ\tSN:c\tLN:10\nr1\t0\tc\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:1\tAS:i:9\n")
    r = records.sam(spark, str(tmp_path / "s.sam")).collect()
    assert len(r) == 1 and (r[0]["pos"], r[0]["nm"], r[0]["as"]) == (5, 1, 9)


def test_streamed_windows_equal_batch(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    events.orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 300).parquet(str(tmp_path / "in"))
    stream = windows.tumbling(windows.event_stream(spark, str(tmp_path / "in")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("tumbled").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    want = events.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    got = spark.table("tumbled")
    assert got.select("window", "event_type", "n").exceptAll(want).isEmpty() and got.count() == want.count()


def test_strict_fasta(spark, tmp_path):
    import pytest

    for k, (text, error) in enumerate([("ACGT\n>c1\nAC\n", "before the first"), (">\nAC\n", "without identifier"), (">c1\n>c2\nAC\n", "without sequence")]):
        (tmp_path / f"{k}.fa").write_text(text)
        with pytest.raises(Exception, match=error):
            records.fasta(spark, str(tmp_path / f"{k}.fa"), strict=True).collect()
    assert [r["id"] for r in records.fasta(spark, str(tmp_path / "0.fa")).collect()] == ["c1"]
    (tmp_path / "p.faa").write_text(">c1_1 # 5 # 10 # 1 # x\nMK*\n>c1_2 # 1 # 4 # -1 # x\nMV\n")
    contigs = spark.createDataFrame([("c1", 10)], "contig string, length long")
    got = {r["orf"]: (r["start"], r["strand"], r["seq"], r["place"]) for r in records.proteins(spark, str(tmp_path / "p.faa"), contigs).collect()}
    assert got == {"c1_1": (5, 1, "MK", 1), "c1_2": (1, -1, "MV", 0)}
    with pytest.raises(Exception, match="outside the contig"):
        records.proteins(spark, str(tmp_path / "p.faa"), contigs.withColumn("length", F.lit(9).cast("long"))).collect()


def test_strict_tables_and_pairs(spark, tmp_path):
    import pytest

    (tmp_path / "h3").write_text("g1\t50.5\t562;0\ng2\t3\tNA\n")
    assert [(r["qseqid"], r["bitscore"], r["taxids"]) for r in records.strict_hits(spark, str(tmp_path / "h3")).collect()] == [("g1", 50.5, [562]), ("g2", 3.0, [])]
    for k, bad in enumerate(["g1\t-1\t5\n", "g1\tinf\t5\n", "g1\t5\n"]):
        (tmp_path / f"bad{k}").write_text(bad)
        with pytest.raises(Exception, match="not a hit"):
            records.strict_hits(spark, str(tmp_path / f"bad{k}")).collect()
    with pytest.raises(ValueError, match="missing columns: original"):
        (tmp_path / "m.csv").write_text("contig,length\nc,1\n")
        records.contig_map(spark, str(tmp_path / "m.csv"))
    for name in ("a_R1.fastq.gz", "a_R2.fastq.gz", "b_1.fq", "notes.txt"):
        (tmp_path / "reads" / name).parent.mkdir(exist_ok=True)
        (tmp_path / "reads" / name).write_text("@r\n")
    got = {r["sample"]: (r["r1"] is not None, r["r2"] is not None) for r in records.file_pairs(spark, str(tmp_path / "reads")).collect()}
    assert got == {"a": (True, True), "b": (True, False)}
    (tmp_path / "bins" / "genus").mkdir(parents=True)
    (tmp_path / "bins" / "genus" / "G1.fasta").write_text(">c1 x\nac\ngt\n>c2\nGG\n")
    assert sorted((r["bin"], r["id"], r["seq"]) for r in records.bin_sequences(spark, str(tmp_path / "bins")).collect()) == [("G1", "c1", "ACGT"), ("G1", "c2", "GG")]
    (tmp_path / "bins" / "genus" / "summary.tsv").write_text("bin\tbp\nG1\t6\n")
    assert [(r["rank"], r["bin"], r["bp"]) for r in records.summaries(spark, str(tmp_path / "bins"), ["bin", "bp"]).collect()] == [("genus", "G1", "6")]


def test_models_are_checked(spark, tmp_path):
    import pytest

    (tmp_path / "p.hmm").write_text("HMMER3/f\nNAME  a\nACC   M1\nLENG  50\nALPH  amino\nGA    20.5 18;\nHMM\n//\nHMMER3/f\nNAME  b\nACC   M2\nLENG  60\nALPH  amino\nTC    10 9;\nGA    1 1;\n//\n")
    m = records.model_headers(spark, str(tmp_path / "p.hmm"))
    assert sorted((r["accession"], r["length"], r["seq_cut"], r["dom_cut"]) for r in m.collect()) == [("M1", 50, 20.5, 18.0), ("M2", 60, 10.0, 9.0)]
    assert records.checked_panel(m, m.select("accession", "body_sha")).count() == 2
    with pytest.raises(Exception, match="changed model"):
        records.checked_panel(m, spark.createDataFrame([("M1", "x")], "accession string, body_sha string")).collect()


def test_unique_and_lower_case(spark, tmp_path):
    import pytest

    (tmp_path / "a.fa").write_text(">c1_1 # 3 # 9 # -1 # x\nacgt\n>c2_1 # 1 # 6 # 1 # x\nAC\n")
    assert sorted(r["seq"] for r in records.fasta(spark, str(tmp_path / "a.fa"), upper=False).collect()) == ["AC", "acgt"]
    assert sorted((r["contig"], r["start"], r["strand"]) for r in records.prodigal(spark, str(tmp_path / "a.fa")).collect()) == [("c1", 3, -1), ("c2", 1, 1)]
    seqs = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, seq string")
    assert records.must_be_unique(seqs).count() == 2
    with pytest.raises(Exception, match="Duplicate identifier: a"):
        records.must_be_unique(seqs.unionByName(seqs.limit(1).select(F.lit("a").alias("id"), "seq"))).collect()


def test_gfa_lines_are_dealt_by_their_beginnings(spark):
    rows = [(("x" * 80 if i % 3 else "") + str(i * 7919 % 3000), "ACGT" * 500) for i in range(3000)]
    segments = spark.createDataFrame(rows, "id string, seq string").repartition(8)
    links = spark.createDataFrame([(str(i % 50), "+", str(i), "-", None) for i in range(400)], "s string, so string, t string, to string, overlap string")
    lines = sinks.gfa_lines(segments, links, 400)
    got = [r["value"] for r in lines.collect()]
    assert got == ["H\tVN:Z:1.0", *sorted(f"S\t{i}\t{s}" for i, s in rows), *sorted(f"L\t{i % 50}\t+\t{i}\t-\t*" for i in range(400))]
    dealt = [x for x in lines._jdf.queryExecution().executedPlan().toString().splitlines() if "rangepartitioning" in x]
    assert dealt and all("substr" in x for x in dealt)  # the driver samples what ranges are made of
