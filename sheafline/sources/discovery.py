"""What lies in a folder of runs: every file is a row, and layouts, preferred stages and missing parts are queries over these rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The parts of a run by the pattern of their path below it; the stage is that of the folder final, else preliminary.
PARTS = {
    "bin": r"^bins/([^/]+)/([^/]+)\.fasta$",
    "bin_summary": r"^bins/([^/]+)/summary\.tsv$",
    "features": r"^annotation/([^/]+)/([^/]+)/features\.tsv$",
    "annotation": r"^annotation/([^/]+)/([^/]+)/bakta/annotation\.json$",
    "classification": r"^classification/()()contig_classification\.tsv$",
    "refinement": r"^classification/()()bin_refinement\.tsv$",
    "feature_table": r"^binarena/()()binarena_input\.tsv$",
    "provenance": r"^assembly/()()contig_provenance\.tsv$",
    "pathways": r"^annotation/([^/]+)/()[^/]+/pathway_summary\.long\.csv$",
}
#: Parts that a stage should have once.
EXPECTED = ("classification", "refinement", "feature_table")
# Files of an assembler's rounds, and suffixes of genomes.
ROUND, FINAL_ROUND, GENOME = r"intermediate_contigs/k(\d+)\.contigs\.fa$", r"intermediate_contigs/k(\d+)\.final\.contigs\.fa$", r"^(.*)\.(?:fasta|fna|fa|fas|fsa)(?:\.gz)?$"


def files(spark: SparkSession, root: str, digests: bool = False) -> DataFrame:
    """run (the first folder below the root), path below the run, size and, if asked for, the SHA-256 of each file's content.

    Without digests no content is read. A digest reads a file in one task.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = re.escape(root.rstrip("/").rsplit("/", 1)[-1])
    below = F.regexp_extract("path", f"/{base}/(.*)$", 1)
    named = rows.select(F.regexp_extract(below, "^([^/]+)/", 1).alias("run"), F.regexp_replace(below, "^[^/]+/", "").alias("path"), F.col("length").alias("size"), *([F.sha2("content", 256).alias("sha256")] if digests else []))
    return named.where("run <> ''")


def _first(path: Column, group: int) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(path, p, group), F.lit("")) for p in PARTS.values()])


def parts(found: DataFrame) -> DataFrame:
    """run, stage, part, rank, name and path of the files that a run's layout knows."""
    final = F.col("path").startswith("final/")
    below = F.when(final, F.expr("substring(path, 7)")).otherwise(F.col("path"))
    part = F.coalesce(*[F.when(below.rlike(p), F.lit(n)) for n, p in PARTS.items()])
    return found.select("*", F.when(final, "final").otherwise("preliminary").alias("stage"), part.alias("part"), _first(below, 1).alias("rank"), _first(below, 2).alias("name")).where("part IS NOT NULL")


def preferred(known: DataFrame, prefer: str = "auto") -> DataFrame:
    """The parts of each run's one stage: final where it has bins, else preliminary; a stage that is asked for is taken as it is."""
    if prefer != "auto":
        return known.where(F.col("stage") == prefer)
    final = F.max(F.when((F.col("stage") == "final") & (F.col("part") == "bin"), 1).otherwise(0)).over(Window.partitionBy("run"))
    return known.withColumn("_final", final).where((F.col("stage") == "final") == (F.col("_final") == 1)).drop("_final")


def missing(known: DataFrame) -> DataFrame:
    """run, part and rank of what is not there: parts that each run should have, and an annotation for each bin that its rank has any for."""
    runs = known.select("run").distinct()
    wanted = runs.select("run", F.explode(F.array(*map(F.lit, EXPECTED))).alias("part"))
    absent = wanted.join(known.select("run", "part").distinct(), ["run", "part"], "left_anti").select("run", "part", F.lit(None).cast("string").alias("rank"), F.lit(None).cast("string").alias("name"))
    annotated = known.where("part IN ('annotation', 'features')")
    bins = known.where("part = 'bin'").join(annotated.select("run", "rank").distinct(), ["run", "rank"], "left_semi")
    bare = bins.join(annotated.select("run", "rank", "name").distinct(), ["run", "rank", "name"], "left_anti").select("run", F.lit("annotation").alias("part"), "rank", "name")
    return absent.unionByName(bare)


def assembler_rounds(found: DataFrame) -> DataFrame:
    """run, k, path and chosen of an assembler's intermediate contigs: of the rounds the one of the largest k, and every round's final contigs."""
    k = lambda p: F.nullif(F.regexp_extract("path", p, 1), F.lit("")).cast("int")
    rounds = found.select("run", "path", F.coalesce(k(FINAL_ROUND), k(ROUND)).alias("k"), F.col("path").rlike(FINAL_ROUND).alias("final")).where("k IS NOT NULL")
    largest = F.max(F.when(~F.col("final"), F.col("k"))).over(Window.partitionBy("run"))
    return rounds.select("run", "k", "path", (F.col("final") | (F.col("k") == largest)).alias("chosen"))


def genomes(found: DataFrame, metadata: DataFrame) -> DataFrame:
    """name, path and the metadata of each genome file; metadata: name and other columns. Files without metadata keep nulls; two files of a name are an error."""
    name = F.regexp_extract(F.element_at(F.split("path", "/"), -1), GENOME, 1)
    given = found.select(name.alias("name"), "path").where("name <> ''")
    one = given.groupBy("name").agg(F.when(F.count("*") > 1, F.raise_error(F.concat(F.lit("several files of one genome: "), F.first("name"))).cast("string")).otherwise(F.max("path")).alias("path"))
    return one.join(metadata, "name", "left")


def tasks(known: DataFrame) -> DataFrame:
    """Over all runs: part, rank, number of runs and files, and of runs whose final stage has it."""
    return known.groupBy("part", "rank").agg(F.countDistinct("run").alias("runs"), F.count("*").alias("files"), F.countDistinct(F.when(F.col("stage") == "final", F.col("run"))).alias("final_runs"))
