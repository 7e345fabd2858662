"""Readers for text formats of sequences, hits, taxonomies, alignments and graphs.

All are spark.read over any store and with any compression that Spark knows. Records that span lines are cut by their
separator, so a large file is read by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DEPTH, PAF


def parse_fasta(rows: DataFrame, upper: bool = True, headless=None) -> DataFrame:
    """id (first word of the header), header and seq of records in a column value, with or without their mark."""
    body = F.regexp_replace("value", "^>", "")
    header = F.trim(F.regexp_extract(body, r"^([^\r\n]*)", 1))
    seq = F.regexp_replace(F.regexp_replace(body, r"^[^\r\n]*", ""), r"\s+", "")
    more = [] if headless is None else [headless.alias("headless")]
    return rows.select(F.regexp_extract(header, r"^(\S+)", 1).alias("id"), header.alias("header"), (F.upper(seq) if upper else seq).alias("seq"), *more)


def fasta(spark: SparkSession, path: str, upper: bool = True, strict: bool = False) -> DataFrame:
    """id (first word of the header), header and seq of the records of files.

    Lines before a file's first header are no record; strict makes them, an empty identifier and an empty sequence an error.
    """
    rows = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    # a file's first piece is the only one that was not cut at a mark: without one of its own it is no record
    first = rows.where("_block = 0").groupBy(F.col("_file").alias("_f")).agg(F.min("_row").alias("_first"))
    marked = rows.join(first, (F.col("_file") == F.col("_f")) & (F.col("_row") == F.col("_first")), "left")
    read = parse_fasta(marked, upper, F.col("_first").isNotNull() & ~F.col("value").startswith(">"))
    if not strict:
        return read.where("NOT headless AND id <> ''").drop("headless")
    wrong = F.when(F.col("headless") & (F.col("header") != ""), "text before the first header").when(~F.col("headless") & (F.col("id") == ""), "record without identifier").when(~F.col("headless") & (F.col("seq") == ""), "record without sequence")
    checked = F.when(wrong.isNotNull(), F.raise_error(F.concat(wrong, F.lit(": "), F.col("header"))).cast("string")).otherwise(F.col("seq"))
    return read.withColumn("seq", checked).where("seq IS NOT NULL AND NOT headless").drop("headless")


def duplicates(records: DataFrame, key: str = "id") -> DataFrame:
    """Keys that occur more than once."""
    return records.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def must_be_unique(records: DataFrame, key: str = "id") -> DataFrame:
    """The records, with an error at run time if a key occurs more than once."""
    per = records.groupBy(key).agg(F.count("*").alias("_n"))
    checked = per.select(key, F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("Duplicate identifier: "), F.col(key)))).cast("string").alias("_bad"))
    return records.join(checked, key).where("_bad IS NULL").drop("_bad")


def table(spark: SparkSession, path: str, schema: str, sep: str = "\t", header: bool = True, strict: bool = False) -> DataFrame:
    """A delimited table with trimmed strings; strict ones fail on rows that do not fit the schema."""
    read = spark.read.schema(schema).option("sep", sep).option("header", header).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    return read.option("mode", "FAILFAST" if strict else "PERMISSIVE").csv(path)


def hits(spark: SparkSession, path: str) -> DataFrame:
    """Seven-column hits and whether a row is malformed; file order is kept as (file, byte offset of its block, place in it)."""
    parts = F.split("value", "\t")
    number = lambda k, t: F.get(parts, F.lit(k)).try_cast(t)
    rows = spark.read.text(path).where("trim(value) <> ''")
    return rows.select(
        F.get(parts, F.lit(0)).alias("qseqid"), F.get(parts, F.lit(1)).alias("sseqid"), number(2, "double").alias("pident"), number(3, "int").alias("length"), number(4, "double").alias("evalue"),
        number(5, "double").alias("bitscore"), F.get(parts, F.lit(6)).alias("staxids"), ((F.size(parts) < 7) | number(5, "double").isNull()).alias("malformed"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("line"),
    )


def taxdump(spark: SparkSession, nodes: str, names: str, merged: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """nodes (taxid, parent, rank), names (taxid, name; scientific ones) and merged (old, new)."""
    cut = lambda p: spark.read.text(p).select(F.transform(F.split("value", r"\|"), lambda x: F.trim(F.translate(x, "\t", ""))).alias("f"))
    at = lambda k: F.get("f", F.lit(k))
    return (
        cut(nodes).select(at(0).cast("int").alias("taxid"), at(1).cast("int").alias("parent"), at(2).alias("rank")),
        cut(names).where(at(3) == "scientific name").select(at(0).cast("int").alias("taxid"), at(1).alias("name")),
        cut(merged).select(at(0).cast("int").alias("old"), at(1).cast("int").alias("new")),
    )


def paf(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, PAF, header=False)


def depth(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, DEPTH, header=False)


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments with the tags NM and AS; header lines are left out."""
    f = F.split("value", "\t")
    tag = lambda t: F.regexp_extract("value", rf"\t{t}:i:(-?\d+)", 1).try_cast("int").alias(t.lower())
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.size(f) >= 11))
    ints = {"flag", "pos", "mapq", "pnext", "tlen"}
    names = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
    return rows.select(*[(f[k].try_cast("int") if n in ints else f[k]).alias(n) for k, n in enumerate(names)], tag("NM"), tag("AS"))


def prodigal(spark: SparkSession, path: str) -> DataFrame:
    """Genes from protein headers: id # start # end # strand # attributes."""
    h = F.split("header", " # ")
    return fasta(spark, path).where(F.size(h) >= 4).select(F.col("id").alias("orf"), F.regexp_extract("id", r"^(.*)_[^_]*$", 1).alias("contig"), h[1].cast("long").alias("start"), h[2].cast("long").alias("end"), h[3].cast("int").alias("strand"), "seq")


def domain_table(spark: SparkSession, path: str) -> DataFrame:
    """HMMER's table of domains, split at white space into its 22 fields and a description."""
    f = F.split(F.trim("value"), r"\s+", 23)
    names = "target tacc tlen query qacc qlen evalue score bias dom doms cevalue ievalue dom_score dom_bias hmm_from hmm_to ali_from ali_to env_from env_to acc".split()
    text = {"target", "tacc", "query", "qacc"}
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return rows.select(*[(f[k] if n in text else f[k].try_cast("double")).alias(n) for k, n in enumerate(names)])


def strict(rows: DataFrame, condition, message) -> DataFrame:
    """The rows (value), with an error at run time for the first one that breaks a condition; message is a column."""
    return rows.withColumn("value", F.when(condition, F.raise_error(F.concat(message, F.lit(": "), F.col("value"))).cast("string")).otherwise(F.col("value")))


def strict_hits(spark: SparkSession, path: str) -> DataFrame:
    """qseqid, bitscore and taxids (array) of three-column hits; a row that does not fit, or a score that is no number from 0 on, is an error.

    NA, 0 and an empty field stand for no taxon.
    """
    parts = F.split("value", "\t")
    score = F.get(parts, F.lit(1)).try_cast("double")
    bad = (F.size(parts) != 3) | score.isNull() | F.isnan(score) | (score < 0) | (score == float("inf"))
    rows = strict(spark.read.text(path).where("trim(value) <> ''"), bad, F.lit("not a hit of three columns"))
    taxa = F.filter(F.transform(F.split(F.get(parts, F.lit(2)), "[;,]"), lambda x: F.trim(x).try_cast("long")), lambda x: x.isNotNull() & (x > 0))
    return rows.select(parts[0].alias("qseqid"), score.alias("bitscore"), taxa.alias("taxids"))


# The columns of wide hits.
WIDE_HITS = "qseqid sseqid pident length mismatch gapopen qstart qend sstart send evalue bitscore staxids superkingdom phylum class order family genus species title".split()


def wide_hits(spark: SparkSession, path: str) -> DataFrame:
    """Hits of 21 columns with names by rank; rows that are too short are left out, N/A is null."""
    f = F.split("value", "\t")
    numbers = {"pident": "double", "length": "long", "evalue": "double", "bitscore": "double"}
    rows = spark.read.text(path).where(F.size(f) >= len(WIDE_HITS) - 1)
    return rows.select(*[F.get(f, F.lit(k)).try_cast(numbers[n]).alias(n) if n in numbers else F.when(~F.get(f, F.lit(k)).isin("N/A", ""), F.get(f, F.lit(k))).alias(n) for k, n in enumerate(WIDE_HITS)])


def proteins(spark: SparkSession, path: str, contigs: DataFrame) -> DataFrame:
    """orf, contig, start, stop, strand, seq and place (from 0, by start, stop and name within its contig) of predicted proteins.

    contigs: contig, length. Coordinates outside the contig, another strand than 1 or -1, an unknown contig and a stop within the
    protein are errors.
    """
    from pyspark.sql import Window

    h = F.split("header", " # ")
    got = fasta(spark, path, strict=True).select(F.col("id").alias("orf"), F.regexp_extract("id", r"^(.*)_[^_]*$", 1).alias("contig"), *[F.get(h, F.lit(k)).try_cast("long").alias(n) for k, n in ((1, "start"), (2, "stop"), (3, "strand"))], F.regexp_replace("seq", r"\*$", "").alias("seq"))
    j = got.join(contigs, "contig", "left")
    wrong = F.when(F.col("length").isNull(), "unknown contig").when(F.coalesce((F.col("start") < 1) | (F.col("stop") > F.col("length")) | (F.col("start") > F.col("stop")), F.lit(True)), "coordinates outside the contig")
    wrong = wrong.when(~F.coalesce(F.col("strand").isin(1, -1), F.lit(False)), "strand").when(F.col("seq").contains("*"), "stop within the protein")
    seq = F.when(wrong.isNotNull(), F.raise_error(F.concat(wrong, F.lit(": "), F.col("orf"))).cast("string")).otherwise(F.col("seq"))
    order = Window.partitionBy("contig").orderBy("start", "stop", "orf")
    return j.select("orf", "contig", "start", "stop", "strand", seq.alias("seq"), (F.row_number().over(order) - 1).cast("long").alias("place"))


def gff(spark: SparkSession, path: str, kind: str = "CDS") -> DataFrame:
    """contig, start, stop and strand of the features of a kind."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.size(f) >= 8) & (F.get(f, F.lit(2)) == kind))
    return rows.select(f[0].alias("contig"), f[3].try_cast("long").alias("start"), f[4].try_cast("long").alias("stop"), F.when(f[6] == "-", -1).otherwise(1).alias("strand"))


def kingdoms(spark: SparkSession, path: str) -> DataFrame:
    """contig (first word), first and second stage of a classifier's table; its header and rows of fewer than three fields are left out."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where((F.size(f) >= 3) & (F.get(f, F.lit(0)) != "sequence_id"))
    return rows.select(F.regexp_extract(f[0], r"^(\S*)", 1).alias("contig"), f[1].alias("tiara"), f[2].alias("stage2"))


def abundance_table(spark: SparkSession, path: str) -> DataFrame:
    """lineage and count of a table without header; lineages may hold commas, the last field is the count."""
    rows = spark.read.text(path).select(F.trim(F.regexp_replace(F.regexp_extract("value", r'^(.*),[^,]*$', 1), '^"|"$', "")).alias("lineage"), F.regexp_extract("value", r",([^,]*)$", 1).try_cast("double").alias("count"))
    return rows.where("count IS NOT NULL")


def references(spark: SparkSession, path: str) -> DataFrame:
    """Names and lengths from the header of an alignment file."""
    rows = spark.read.text(path).where(F.col("value").startswith("@SQ\t"))
    return rows.select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("contig"), F.regexp_extract("value", r"\tLN:(\d+)", 1).try_cast("long").alias("length"))


def required(table_: DataFrame, columns: list[str]) -> DataFrame:
    """The table, if it has the columns."""
    if missing := [c for c in columns if c not in table_.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return table_


def quality_table(spark: SparkSession, path: str) -> DataFrame:
    """rank, bin and the numbers of a quality table whose bins are named rank__bin."""
    fields = ["Bin Id", "Completeness", "Contamination", "Strain heterogeneity", "Marker lineage"]
    rows = required(spark.read.option("sep", "\t").option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path), fields)
    name = F.split(F.col("Bin Id"), "__", 2)
    number = lambda c: F.col(c).try_cast("double")
    return rows.select(F.when(F.size(name) == 2, name[0]).alias("rank"), F.element_at(name, -1).alias("bin"), number("Completeness").alias("completeness"), number("Contamination").alias("contamination"), number("Strain heterogeneity").alias("heterogeneity"), F.col("Marker lineage").alias("lineage"))


FEATURES = "features array<struct<type:string,contig:string,sequence:string,sequence_id:string,locus:string,id:string,start:long,stop:long,strand:string,gene:string,product:string,hypothetical:boolean,pseudogene:boolean,truncated:string,aa:string,nt:string>>"


def annotation(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """Features of annotations in JSON (one in each file, or one on each line), a row each, with the contig under whichever name it has, and details derived.

    hypothetical is what the file says, else whether the product says so; lengths are of the sequences that are there.
    """
    rows = spark.read.schema(FEATURES).option("multiLine", whole).json(path).select(F.explode("features").alias("f")).select("f.*")
    said = F.lower(F.coalesce("product", F.lit(""))).contains("hypothetical")
    return rows.select(
        F.coalesce("contig", "sequence", "sequence_id").alias("contig"), F.coalesce("locus", "id").alias("locus"), "type", "start", "stop", "strand", "gene", "product", F.coalesce("hypothetical", F.when(F.col("product").isNotNull(), said)).alias("hypothetical"), "pseudogene",
        F.col("truncated").isNotNull().alias("truncated"), F.length("aa").cast("long").alias("aa_length"), F.length("nt").cast("long").alias("nt_length"),
    )


def model_headers(spark: SparkSession, path: str) -> DataFrame:
    """name, accession, length, alphabet, both cutoffs (the first kind that is there) and body_sha of profile models in a file."""
    rows = spark.read.option("lineSep", "//\n").text(path).where("trim(value) <> ''")
    at = lambda k: F.regexp_extract("value", rf"(?m)^{k}\s+(\S+)", 1)
    cut = lambda k, g: F.regexp_extract("value", rf"(?m)^{k}\s+([-0-9.]+)\s+([-0-9.]+)", g).try_cast("double")
    return rows.select(at("NAME").alias("name"), F.nullif(at("ACC"), F.lit("")).alias("accession"), at("LENG").try_cast("long").alias("length"), at("ALPH").alias("alphabet"), F.coalesce(cut("TC", 1), cut("GA", 1)).alias("seq_cut"), F.coalesce(cut("TC", 2), cut("GA", 2)).alias("dom_cut"), F.sha2("value", 256).alias("body_sha"))


def checked_panel(models: DataFrame, manifest: DataFrame) -> DataFrame:
    """Models of a panel whose body is the one that the manifest (accession, body_sha) knows; another body, or none, is an error."""
    j = manifest.select("accession", F.col("body_sha").alias("_sha")).join(models, "accession", "left")
    wrong = F.when(F.col("body_sha").isNull(), "missing model").when(F.col("body_sha") != F.col("_sha"), "changed model")
    return j.withColumn("length", F.when(wrong.isNotNull(), F.raise_error(F.concat(wrong, F.lit(": "), F.col("accession"))).cast("long")).otherwise(F.col("length"))).drop("_sha")


def contig_map(spark: SparkSession, path: str) -> DataFrame:
    """original and normalised names and lengths of contigs."""
    return required(spark.read.option("header", True).csv(path), ["contig", "original", "length"]).select("contig", "original", F.col("length").try_cast("long").alias("length"))


def summaries(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Summary tables of all ranks below a folder, bins/<rank>/summary.tsv, with the rank from the path."""
    rows = required(spark.read.option("sep", "\t").option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "summary*").csv(path), fields)
    return rows.select(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]*$", 1).alias("rank"), *fields)


def bin_sequences(spark: SparkSession, path: str, suffix: str = "*.f*a*") -> DataFrame:
    """bin (the file's name without its suffixes), id and seq of all bins below a folder."""
    rows = spark.read.option("lineSep", "\n>").option("recursiveFileLookup", True).option("pathGlobFilter", suffix).text(path)
    named = rows.select("value", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.(?:fa|fna|fasta))?(?:\.gz)?$", 1).alias("bin"))
    return named.select("bin", F.regexp_extract(F.regexp_replace("value", "^>", ""), r"^(\S*)", 1).alias("id"), F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s+", "")).alias("seq")).where("id <> ''")


def file_pairs(spark: SparkSession, path: str, pattern: str = r"^(.+?)[._]R?([12])(?:_001)?\.f(?:ast)?q(?:\.gz)?$") -> DataFrame:
    """sample, first and second read file below a folder; several files of a mate are an error, a missing one is null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))
    named = files.select("path", F.regexp_extract("name", pattern, 1).alias("sample"), F.regexp_extract("name", pattern, 2).alias("mate")).where("sample <> ''")
    mate = lambda m: F.when(F.sum((F.col("mate") == m).cast("int")) > 1, F.raise_error(F.concat(F.lit("several files of one mate: "), F.first("sample"))).cast("string")).otherwise(F.max(F.when(F.col("mate") == m, F.col("path"))))
    return named.groupBy("sample").agg(mate("1").alias("r1"), mate("2").alias("r2"))
