"""Queries that write the given tables in the file formats of the field and read them back, with the SQL of what must come out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals
from ..session import folder, table
from ..sources import graphs, records, sinks
from .networks import _SEQ, _sequences
from .shapes import shape, sql


def lines(spark: SparkSession, rows: DataFrame, *columns, sep: str = "\t") -> str:
    """The path of a folder of text files with the columns of each row on a line."""
    path = folder(spark)
    rows.select(F.concat_ws(sep, *columns).alias("value")).write.text(path)
    return path


def q180_fasta(spark, d):
    path = folder(spark)
    sinks.write_fasta(_sequences(spark, d).select(F.concat(F.lit("d"), "id").alias("id"), "seq").where("seq <> ''"), path)
    return records.fasta(spark, path, strict=True).select("id", F.sha2("seq", 256).alias("sha"), F.length("seq").cast("long").alias("n"))


def q181_bin_fasta(spark, d):
    """A folder for each bin, and the sizes of its sequences on reading."""
    path = folder(spark)
    sinks.write_fasta(_sequences(spark, d).join(table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("bin")), "id").where("seq <> ''").select(F.col("id").cast("string").alias("id"), "seq", "bin"), path, ["bin"], 80)
    read = spark.read.option("lineSep", "\n>").text(path)
    named = read.select("bin", F.regexp_extract(F.regexp_replace("value", "^>", ""), r"^(\S+)", 1).alias("id"))
    return named.groupBy("bin").agg(F.count("*").cast("long").alias("contigs"))


def q182_hits(spark, d):
    h = table(spark, d, "lineitem")
    path = lines(spark, h, F.concat("l_orderkey", F.lit("_1")), "l_suppkey", "l_quantity", F.when(F.col("l_linenumber") == 3, F.lit("x")).otherwise(F.col("l_linenumber").cast("string")), F.lit("1e-5"), F.when(F.col("l_returnflag") == "R", F.lit("bad")).otherwise(F.floor("l_extendedprice").cast("string")), "l_partkey")
    read = records.hits(spark, path)
    return read.groupBy("malformed").agg(F.count("*").cast("long").alias("n"), F.sum(F.col("bitscore").cast("long")).alias("score"), F.count("length").cast("long").alias("lengths"))


def q183_strict_hits(spark, d):
    h = table(spark, d, "lineitem")
    path = lines(spark, h, F.concat(F.lit("g"), "l_orderkey"), F.floor("l_extendedprice").cast("long"), F.when(F.col("l_returnflag") == "A", F.lit("NA")).otherwise(F.concat_ws(";", "l_suppkey", F.lit("0"), "l_partkey")))
    return records.strict_hits(spark, path).groupBy("qseqid").agg(F.sum(F.col("bitscore").cast("long")).alias("score"), F.sum(F.size("taxids")).cast("long").alias("taxa"))


def q184_wide_hits(spark, d):
    h = table(spark, d, "lineitem")
    filler = [F.lit("0")] * 6
    path = lines(spark, h, F.concat(F.lit("g"), "l_orderkey"), "l_suppkey", F.floor("l_quantity"), "l_linenumber", *filler, F.lit("1e-9"), F.floor("l_extendedprice").cast("long"), "l_partkey", F.lit("Bacteria"), *[F.when(F.col("l_returnflag") == "N", F.lit("N/A")).otherwise(F.concat(F.lit(r), F.col("l_suppkey") % 5)) for r in "pcofgs"], F.lit("some title"))
    return records.wide_hits(spark, path).groupBy("genus").agg(F.count("*").cast("long").alias("n"), F.sum(F.col("bitscore").cast("long")).alias("score"))


def q185_sam(spark, d):
    a = shape(spark, d, "alignments")
    path = lines(spark, a, "qname", "flag", "rname", "pos", "mapq", "cigar", F.lit("="), "pnext", "tlen", F.lit("*"), "qual", F.concat(F.lit("NM:i:"), "nm"), F.concat(F.lit("AS:i:"), "score"))
    read = records.sam(spark, path)
    return read.groupBy("flag").agg(F.count("*").cast("long").alias("n"), F.sum("nm").cast("long").alias("nm"), F.sum("as").cast("long").alias("score"), F.sum(F.length("qual")).cast("long").alias("bases"), F.sum("pnext").cast("long").alias("pnext"))


def q186_references(spark, d):
    o = shape(spark, d, "originals")
    path = lines(spark, o, F.lit("@SQ"), F.concat(F.lit("SN:"), "contig"), F.concat(F.lit("LN:"), "length"), F.lit("M5:x"))
    return records.references(spark, path)


def q187_paf(spark, d):
    p = shape(spark, d, "paf")
    path = lines(spark, p, "qname", F.lit(100), "lo", "hi", F.lit("+"), F.lit("t"), F.lit(9), F.lit(0), F.lit(9), "nmatch", "alen", F.lit(60), F.lit("tp:A:P"))
    return records.paf(spark, path).groupBy("qname").agg(F.sum("nmatch").alias("nmatch"), F.sum("alen").alias("alen"), F.min("qstart").alias("lo"), F.max("qend").alias("hi"))


def q188_depth(spark, d):
    e = table(spark, d, "events").groupBy("user_id", F.hour("ts").alias("pos")).agg(F.count("*").alias("depth"))
    return records.depth(spark, lines(spark, e, "user_id", "pos", "depth")).groupBy("contig").agg(F.sum("depth").alias("bases"), F.count("*").cast("long").alias("covered"))


def q189_taxdump(spark, d):
    n, s = table(spark, d, "nation"), table(spark, d, "supplier")
    bar = lambda *c: [x for y in c for x in (y, F.lit("|"))]
    nodes = lines(spark, n, *bar(F.col("n_nationkey"), F.col("n_regionkey") + 1000, F.lit("genus")))
    names = lines(spark, n.crossJoin(spark.createDataFrame([("scientific name",), ("synonym",)], "kind string")), *bar(F.col("n_nationkey"), F.concat("n_name", F.lit(" x")), F.lit(""), F.col("kind")))
    merged = lines(spark, s, *bar(F.col("s_suppkey") + 5000, F.col("s_nationkey")))
    a, b, c = records.taxdump(spark, nodes, names, merged)
    per = c.groupBy(F.col("new").alias("taxid")).agg(F.count("*").cast("long").alias("merged"))
    return a.join(b, "taxid").join(per, "taxid", "left").select("taxid", "parent", "rank", "name", "merged")


def q190_proteins(spark, d):
    o = shape(spark, d, "orfs")
    path = folder(spark)
    named = o.select(F.concat_ws(" # ", F.concat(F.lit("c"), "contig", F.lit("_"), "orf"), "start", "stop", "strand", F.lit("ID=1")).alias("id"), F.lit("MKV*").alias("seq"))
    sinks.write_fasta(named, path)
    contigs = o.select(F.concat(F.lit("c"), "contig").alias("contig"), F.lit(5000).alias("length")).distinct()
    return records.proteins(spark, path, contigs).select("orf", "contig", "start", "stop", "strand", "seq", "place")


def q191_gff_density(spark, d):
    """Coding density by the union of genes, and their mean length."""
    o = shape(spark, d, "orfs")
    path = lines(spark, o, F.concat(F.lit("c"), "contig"), F.lit("x"), F.when(F.col("orf") % 9 == 0, "gene").otherwise("CDS"), "start", "stop", F.lit("."), F.when(F.col("strand") == 1, "+").otherwise("-"), F.lit("0"), F.lit("ID=1"))
    cds = records.gff(spark, path)
    union = intervals.union_length(cds, ["contig"], "start", "stop", inclusive=True)
    mean = cds.groupBy("contig").agg(F.round(F.avg(F.col("stop") - F.col("start") + 1), 4).alias("mean_cds"))
    return union.join(mean, "contig").select("contig", F.round(F.col("union_bp") / 5000, 6).alias("density"), "mean_cds")


def q192_kingdoms(spark, d):
    c = shape(spark, d, "contigs")
    path = lines(spark, c, F.concat("contig", F.lit(" len="), "length"), F.coalesce("tiara", F.lit("unknown")), F.lit("n/a"), F.lit("0.5"))
    return records.kingdoms(spark, path).groupBy("tiara").agg(F.count("*").cast("long").alias("n"), F.sum(F.col("contig").cast("long")).alias("ids"))


def q193_abundance_table(spark, d):
    p = table(spark, d, "part")
    path = lines(spark, p, F.concat_ws(";", "p_brand", F.concat("p_name", F.lit(", sensu lato"))), F.when(F.col("p_partkey") % 10 == 0, F.lit("many")).otherwise(F.col("p_size").cast("string")), sep=",")
    return records.abundance_table(spark, path).groupBy("lineage").agg(F.sum("count").alias("count"))


def q194_quality_table(spark, d):
    b = shape(spark, d, "bins").select(F.concat_ws("__", "rank", "bin").alias("Bin Id"), F.coalesce(F.col("completeness").cast("string"), F.lit("NA")).alias("Completeness"), F.col("contamination").alias("Contamination"), F.lit(0.0).alias("Strain heterogeneity"), F.concat(F.lit("k__"), "bin").alias("Marker lineage"))
    path = folder(spark)
    sinks.write_table(b, path, b.columns)
    return records.quality_table(spark, path).select("rank", "bin", "completeness", "contamination", "lineage")


def q195_annotation_json(spark, d):
    f = shape(spark, d, "features")
    name = lambda k: F.when(F.col("locus") % 3 == k, F.col("contig").cast("string"))
    feature = F.struct(F.col("kind").alias("type"), name(0).alias("contig"), name(1).alias("sequence"), name(2).alias("sequence_id"), F.concat(F.lit("L"), "locus").alias("locus"), F.col("at").alias("start"), (F.col("at") + 99).alias("stop"), F.when(F.col("locus") % 5 != 0, F.col("product")).alias("product"), F.when(F.col("locus") % 4 == 0, F.col("locus") % 8 == 0).alias("hypothetical"), F.repeat(F.lit("M"), (F.col("locus") % 7).cast("int")).alias("aa"))
    path = folder(spark)
    f.withColumn("f", feature).groupBy("contig").agg(F.to_json(F.struct(F.collect_list("f").alias("features"))).alias("value")).select("value").write.text(path)
    return records.annotation(spark, path, whole=False).groupBy("contig", "type").agg(F.count("*").cast("long").alias("n"), F.sum(F.col("hypothetical").cast("int")).cast("long").alias("hypothetical"), F.sum("aa_length").alias("aa"), F.sum("stop").alias("stop"))


def q196_models(spark, d):
    m = shape(spark, d, "models")
    path = folder(spark)
    text = F.concat_ws("\n", F.lit("HMMER3/f"), F.concat(F.lit("NAME  n"), "model"), F.concat(F.lit("ACC   "), "accession"), F.concat(F.lit("LENG  "), "length"), F.lit("ALPH  amino"), F.concat(F.when(F.col("model") % 2 == 0, "TC    ").otherwise("GA    "), "seq_cut", F.lit(" "), "dom_cut", F.lit(";")), F.lit("HMM  A C"), F.lit(""))
    m.select(text.alias("value")).write.option("lineSep", "//\n").text(path)
    models = records.model_headers(spark, path)
    return records.checked_panel(models, models.select("accession", "body_sha")).select("accession", "name", "length", "alphabet", "seq_cut", "dom_cut")


def q197_contig_map(spark, d):
    from ..operators import checks

    o = shape(spark, d, "originals")
    named = checks.numbered(o, ["contig"], "c", 7).select(F.col("new_id").alias("contig"), F.col("contig").alias("original"), "length")
    path = folder(spark)
    named.write.option("header", True).csv(path)
    return records.contig_map(spark, path)


def q198_summaries(spark, d):
    path = folder(spark)
    for rank in ("genus", "family", "species", "clade", "order"):
        sinks.write_table(shape(spark, d, "bins").where(F.col("rank") == rank), f"{path}/bins/{rank}/summary.tsv", ["bin", "bp", "contigs"])
    rows = spark.read.option("sep", "\t").option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").csv(path)
    return rows.select(F.regexp_extract(F.col("_metadata.file_path"), r"/bins/([^/]+)/", 1).alias("rank"), "bin", F.col("bp").cast("long").alias("bp"), F.col("contigs").cast("long").alias("contigs"))


def q199_gfa(spark, d):
    s = _sequences(spark, d).where("seq <> ''").select(F.col("id").cast("string").alias("id"), "seq")
    line = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("s"), F.when(F.col("l_linenumber") % 2 == 0, "+").otherwise("-").alias("so"), F.col("l_suppkey").cast("string").alias("t"), F.lit("+").alias("to"), F.lit("8M").alias("overlap")).distinct()
    path = folder(spark)
    sinks.gfa_lines(s, line, 100_000_000).write.text(path)
    got = graphs.graph(spark, path, strict=False)  # links of the stand-in name segments that it has not
    return got["segments"].agg(F.count("*").cast("long").alias("n"), F.sum("length").alias("total")).withColumn("kind", F.lit("S")).unionByName(got["links"].groupBy(F.concat(F.lit("L"), "so").alias("kind")).agg(F.count("*").cast("long").alias("n"), F.sum(F.col("s").cast("long") + F.col("t").cast("long")).alias("total")))


def q200_domain_table(spark, d):
    """Domains through the program's own table, reduced to the best domain of each hit."""
    from ..operators import pathways

    x = shape(spark, d, "domains")
    zero = F.lit("0")
    path = lines(spark, x, F.concat(F.lit("p"), "protein"), F.lit("-"), zero, "accession", "accession", F.lit("90"), F.lit("1e-9"), "seq_score", zero, F.lit("1"), F.lit("1"), "ievalue", "ievalue", "dom_score", zero, "hmm_from", "hmm_to", zero, zero, zero, zero, F.lit("0.9"), F.lit("a description of it"), sep="  ")
    read = records.domain_table(spark, path).select("target", "query", "dom_score", "ievalue", "score", "hmm_from", "hmm_to")
    best = pathways.best_domain(read, ["target", "query"], "dom_score", "ievalue")
    return best.select("target", "query", F.col("dom_score").cast("long").alias("dom_score"), F.col("least").cast("long").alias("least"), "domains")


def q201_union_of_fields(spark, d):
    """Rows of three tables with all their fields, written and read again."""
    b = shape(spark, d, "bins")
    whole = sinks.union_of_fields([b.select("bin", "rank"), b.select("bin", "bp").where("bp > 0"), b.select("bin", "contigs", "completeness")])
    path = folder(spark)
    sinks.write_table(whole, path, ["bin", "rank", "bp", "contigs", "nothing"])
    return spark.read.option("sep", "\t").option("header", True).csv(path).groupBy("bin").agg(F.max("rank").alias("rank"), F.max(F.col("bp").cast("long")).alias("bp"), F.max(F.col("contigs").cast("long")).alias("contigs"), F.count("nothing").cast("long").alias("nothing"), F.count("*").cast("long").alias("n"))


def q202_read_pools(spark, d):
    """Reads of each bin and mate as a folder of records, counted on reading."""
    from ..operators import mapping

    rows = shape(spark, d, "alignments")
    bins = shape(spark, d, "originals").where("domain <> 'Unclassified'").select("contig", "bin")
    routed = mapping.route_pairs(rows, bins, strict=False).where("routing = 'accepted'")
    mate = F.when(F.col("flag").bitwiseAND(64) != 0, "R1").otherwise("R2")
    taken = mapping.primary(rows).join(routed.select("qname", "bin"), "qname").select("bin", mate.alias("mate"), F.concat_ws("\n", F.concat(F.lit("@"), "qname"), F.lit("ACGT"), F.lit("+"), F.lit("IIII")).alias("value"))
    path = folder(spark)
    taken.write.partitionBy("bin", "mate").text(path)
    return spark.read.text(path).where(F.col("value").startswith("@")).groupBy("bin", "mate").agg(F.count("*").cast("long").alias("reads"), F.sum(F.substring("value", 2, 20).cast("long")).alias("names"))


SQL = {
    "q180_fasta": f"WITH {_SEQ} SELECT 'd' || id AS id, sha256(seq) AS sha, length(seq) AS n FROM seqs WHERE seq <> ''",
    "q181_bin_fasta": f"WITH {_SEQ} SELECT lang AS bin, count(*) AS contigs FROM seqs JOIN documents ON id = doc_id WHERE seq <> '' GROUP BY 1",
    "q182_hits": "SELECT l_returnflag = 'R' AS malformed, count(*) AS n, CAST(CASE WHEN l_returnflag = 'R' THEN NULL ELSE sum(CAST(floor(l_extendedprice) AS BIGINT)) END AS BIGINT) AS score, count(CASE WHEN l_linenumber <> 3 THEN 1 END) AS lengths FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 'R' ELSE 'x' END AS l_returnflag, l_extendedprice, l_linenumber FROM lineitem) GROUP BY l_returnflag",
    "q183_strict_hits": "SELECT 'g' || l_orderkey AS qseqid, CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS score, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 0 ELSE CASE WHEN l_suppkey > 0 THEN 1 ELSE 0 END + CASE WHEN l_partkey > 0 THEN 1 ELSE 0 END END) AS BIGINT) AS taxa FROM lineitem GROUP BY 1",
    "q184_wide_hits": "SELECT CASE WHEN l_returnflag <> 'N' THEN 'g' || l_suppkey % 5 END AS genus, count(*) AS n, CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS score FROM lineitem GROUP BY 1",
    "q185_sam": f"WITH {sql('alignments')} SELECT flag, count(*) AS n, CAST(sum(nm) AS BIGINT) AS nm, CAST(sum(score) AS BIGINT) AS score, CAST(sum(length(qual)) AS BIGINT) AS bases, CAST(sum(pnext) AS BIGINT) AS pnext FROM alignments GROUP BY 1",
    "q186_references": f"WITH {sql('originals')} SELECT CAST(contig AS VARCHAR) AS contig, length FROM originals",
    "q187_paf": f"WITH {sql('paf')} SELECT CAST(qname AS VARCHAR) AS qname, CAST(sum(nmatch) AS BIGINT) AS nmatch, CAST(sum(alen) AS BIGINT) AS alen, min(lo) AS lo, max(hi) AS hi FROM paf GROUP BY 1",
    "q188_depth": "WITH e AS (SELECT user_id, hour(ts) AS pos, count(*) AS depth FROM events GROUP BY ALL) SELECT CAST(user_id AS VARCHAR) AS contig, CAST(sum(depth) AS BIGINT) AS bases, count(*) AS covered FROM e GROUP BY 1",
    "q189_taxdump": "SELECT n_nationkey AS taxid, n_regionkey + 1000 AS parent, 'genus' AS rank, n_name || ' x' AS name, m AS merged FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS m FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey",
    "q190_proteins": f"WITH {sql('orfs')}, o AS (SELECT *, 'c' || contig || '_' || orf AS name FROM orfs) SELECT name AS orf, 'c' || contig AS contig, start, stop, CAST(strand AS BIGINT) AS strand, 'MKV' AS seq, row_number() OVER (PARTITION BY contig ORDER BY start, stop, name) - 1 AS place FROM o",
    "q191_gff_density": f"""WITH {sql("orfs")}, g AS (SELECT 'c' || contig AS contig, start, stop FROM orfs WHERE orf % 9 <> 0), w AS (SELECT *, max(stop) OVER (PARTITION BY contig ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM (SELECT DISTINCT * FROM g)),
u AS (SELECT contig, sum(greatest(0, stop + 1 - greatest(start, coalesce(top + 1, start)))) AS bp FROM w GROUP BY 1), m AS (SELECT contig, round(avg(stop - start + 1), 4) AS mean_cds FROM g GROUP BY 1) SELECT contig, round(CAST(bp AS DOUBLE) / 5000, 6) AS density, mean_cds FROM u JOIN m USING (contig)""",
    "q192_kingdoms": f"WITH {sql('contigs')} SELECT coalesce(tiara, 'unknown') AS tiara, count(*) AS n, CAST(sum(contig) AS BIGINT) AS ids FROM contigs GROUP BY 1",
    "q193_abundance_table": "SELECT p_brand || ';' || p_name || ', sensu lato' AS lineage, CAST(sum(p_size) AS DOUBLE) AS count FROM part WHERE p_partkey % 10 <> 0 GROUP BY 1",
    "q194_quality_table": f"WITH {sql('bins')} SELECT rank, bin, completeness, contamination, 'k__' || bin AS lineage FROM bins",
    "q195_annotation_json": f"""WITH {sql("features")} SELECT CAST(contig AS VARCHAR) AS contig, kind AS type, count(*) AS n, CAST(sum(CASE WHEN locus % 4 = 0 THEN CASE WHEN locus % 8 = 0 THEN 1 ELSE 0 END WHEN locus % 5 <> 0 THEN CASE WHEN contains(lower(product), 'hypothetical') THEN 1 ELSE 0 END END) AS BIGINT) AS hypothetical,
  CAST(sum(locus % 7) AS BIGINT) AS aa, CAST(sum("at" + 99) AS BIGINT) AS stop FROM features GROUP BY 1, 2""",
    "q196_models": f"WITH {sql('models')} SELECT accession, 'n' || model AS name, length, 'amino' AS alphabet, CAST(seq_cut AS DOUBLE) AS seq_cut, CAST(dom_cut AS DOUBLE) AS dom_cut FROM models",
    "q197_contig_map": f"WITH {sql('originals')} SELECT 'c' || lpad(CAST(row_number() OVER (ORDER BY contig) AS VARCHAR), 7, '0') AS contig, CAST(contig AS VARCHAR) AS original, length FROM originals",
    "q198_summaries": f"WITH {sql('bins')} SELECT rank, bin, CAST(bp AS BIGINT) AS bp, CAST(contigs AS BIGINT) AS contigs FROM bins",
    "q199_gfa": f"""WITH {_SEQ}, l AS (SELECT DISTINCT l_partkey AS s, CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS so, l_suppkey AS t FROM lineitem)
SELECT 'S' AS kind, count(*) AS n, CAST(sum(length(seq)) AS BIGINT) AS total FROM seqs WHERE seq <> '' UNION ALL SELECT 'L' || so, count(*), CAST(sum(s + t) AS BIGINT) FROM l GROUP BY so""",
    "q200_domain_table": f"WITH {sql('domains')} SELECT 'p' || protein AS target, accession AS query, max(dom_score) AS dom_score, min(ievalue) AS least, count(*) AS domains FROM domains GROUP BY 1, 2",
    "q201_union_of_fields": f"WITH {sql('bins')} SELECT bin, rank, CASE WHEN bp > 0 THEN CAST(bp AS BIGINT) END AS bp, CAST(contigs AS BIGINT) AS contigs, CAST(0 AS BIGINT) AS nothing, CAST(CASE WHEN bp > 0 THEN 3 ELSE 2 END AS BIGINT) AS n FROM bins",
    "q202_read_pools": None,
}


def _pools_sql():
    from . import reads

    return f"WITH {reads._PAIRS} SELECT x AS bin, CASE WHEN flag & 64 <> 0 THEN 'R1' ELSE 'R2' END AS mate, count(*) AS reads, CAST(sum(qname) AS BIGINT) AS names FROM p JOIN r USING (qname) WHERE routing = 'accepted' GROUP BY 1, 2"


SQL["q202_read_pools"] = _pools_sql()
QUERIES = {name: globals()[name] for name in SQL}
