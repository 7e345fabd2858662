"""Feature sets of bins from whichever source a bin has: its annotation in JSON, else its feature table; sequences from FASTA where they lack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("locus", "gene", "product", "kind", "contig", "start", "stop", "strand", "refs")


def _text(path: str) -> Column:
    """A value as text; null for an empty one."""
    return F.nullif(F.try_variant_get("f", path, "string"), F.lit(""))


def _is(path: str, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get("f", path, "variant")).startswith(kind), F.lit(False))


def _flag(c: Column) -> Column:
    """What a text says of a flag; words for nothing known are null."""
    low = F.lower(F.trim(c))
    return F.when(low.isin("", "na", "n/a", "unknown", "unavailable", "null", "none"), F.lit(None).cast("boolean")).otherwise(~low.isin("false", "no", "0"))


def from_json(records: DataFrame, contigs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Features of annotations (bin, json), and (bin, error) of the annotations that cannot be used.

    Records change their shape from feature to feature, so each is a VARIANT: a contig is named directly, or by an object with an id, under
    any of three names; cross references are a list or a text; a pseudogene is a flag or an object that describes it. A bin whose
    contigs (bin, contig) are known may hold features on these only.
    """
    parsed = records.select("bin", F.try_parse_json(F.col("json")).alias("v"))
    listed = parsed.select("bin", F.try_variant_get("v", "$.features", "array<variant>").alias("fs"))
    each = listed.select("bin", F.posexplode("fs").alias("i", "f")).withColumn("number", (F.col("i") + 1).cast("long"))
    contig = F.coalesce(*[F.when(_is(p, "OBJECT"), _text(p + ".id")).otherwise(_text(p)) for p in ("$.sequence", "$.contig", "$.sequence_id")], F.lit(""))
    refs = F.coalesce(*[F.when(_is(p, "ARRAY"), F.nullif(F.array_join(F.try_variant_get("f", p, "array<string>"), ";"), F.lit(""))).otherwise(_text(p)) for p in ("$.db_xrefs", "$.dbxref")], F.lit(""))
    kind, product = F.lower(F.coalesce(_text("$.type"), F.lit(""))), F.coalesce(_text("$.product"), F.lit(""))
    named = F.try_variant_get("f", "$.hypothetical", "variant").isNotNull()
    hypothetical = F.when(kind.isin("cds", "sorf"), F.when(named, F.when(_is("$.hypothetical", "OBJECT"), True).otherwise(_flag(F.try_variant_get("f", "$.hypothetical", "string")))).when(product != "", F.lower(product).startswith("hypothetical protein")))
    key = lambda x: F.when(F.try_variant_get("f", "$.pseudogene", "variant").isNotNull(), F.lit("pseudogene")).otherwise(F.lit("pseudo")) if x else None
    held = lambda p: F.when(_is(p, "OBJECT"), True).otherwise(F.coalesce(_flag(F.try_variant_get("f", p, "string")), F.lit(False)))
    pseudo = F.when(key(1) == "pseudogene", held("$.pseudogene")).otherwise(held("$.pseudo"))
    note = F.coalesce(*[_text(f"$.{p}.{w}") for p in ("pseudogene", "pseudo") for w in ("description", "reason")], F.lit(""))
    made = each.select(
        "bin", "number", F.coalesce(_text("$.locus"), _text("$.locus_tag"), _text("$.id"), F.lit("")).alias("locus"), F.coalesce(_text("$.gene"), F.lit("")).alias("gene"), product.alias("product"), kind.alias("kind"), contig.alias("contig"),
        F.coalesce(_text("$.start"), F.lit("")).alias("start"), F.coalesce(_text("$.stop"), _text("$.end"), F.lit("")).alias("stop"), F.coalesce(_text("$.strand"), F.lit("")).alias("strand"), refs.alias("refs"),
        hypothetical.alias("hypothetical"), pseudo.alias("pseudogene"), note.alias("pseudogene_note"), F.coalesce(_text("$.truncated"), F.lit("")).alias("truncated"), _text("$.aa").alias("aa"), _text("$.nt").alias("nt"),
        F.coalesce(F.schema_of_variant("f").startswith("OBJECT"), F.lit(False)).alias("_object"),
    )
    bad = made.where("NOT _object").groupBy("bin").agg(F.min("number").alias("n")).select("bin", F.concat(F.lit("feature "), "n", F.lit(" is not an object")).alias("error"))
    errors = listed.where("fs IS NULL").select("bin", F.lit("no features array").alias("error")).unionByName(bad)
    if contigs is not None:
        known = contigs.select("bin").distinct().withColumn("_known", F.lit(True))
        outside = made.where("_object").join(known, "bin").join(contigs.select("bin", "contig").distinct(), ["bin", "contig"], "left_anti")
        first = outside.groupBy("bin").agg(F.min(F.struct("number", "contig")).alias("x"))
        errors = errors.unionByName(first.select("bin", F.concat(F.lit("feature "), "x.number", F.lit(" is on a contig outside the bin: "), "x.contig").alias("error")))
    return made.drop("_object"), errors.groupBy("bin").agg(F.min("error").alias("error"))


def from_table(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same of feature tables (bin, number, own_bin and FIELDS); a row that names another bin is an error. Flags are unknown there."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    kind, product = F.lower(F.coalesce(F.col("kind").cast("string"), F.lit(""))), F.coalesce(F.col("product").cast("string"), F.lit(""))
    hypothetical = F.when(kind.isin("cds", "sorf") & (product != ""), F.lower(product).startswith("hypothetical protein"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("pseudogene", "boolean"),)] + [F.lit("").alias("pseudogene_note"), F.lit("").alias("truncated")] + [F.lit(None).cast("string").alias(c) for c in ("aa", "nt")]
    made = rows.select("bin", "number", *map(text, FIELDS), hypothetical.alias("hypothetical"), *none)
    wrong = rows.where(F.coalesce(F.col("own_bin"), F.lit("")) != "").where("own_bin <> bin").groupBy("bin").agg(F.min("number").alias("n"))
    return made, wrong.select("bin", F.concat(F.lit("row "), "n", F.lit(" belongs to a different bin")).alias("error"))


def feature_sets(bins: DataFrame, json: DataFrame, tables: DataFrame, sequences: DataFrame, contigs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The features of all bins, and for each bin its source (json, table or none), number of features and error.

    A bin with an annotation in JSON uses it and no other source, even where it is broken; a bin with an error keeps no features. sequences
    (bin, locus, field: aa or nt, seq) fill in what a feature lacks; of repeated ones the first in order counts.
    """
    a, a_bad = from_json(json.join(bins.select("bin"), "bin", "left_semi"), contigs)
    given = json.select("bin").distinct()
    b, b_bad = from_table(tables.join(bins.select("bin"), "bin", "left_semi").join(given, "bin", "left_anti"))
    errors = a_bad.unionByName(b_bad)
    features = a.withColumn("source", F.lit("json")).unionByName(b.withColumn("source", F.lit("table"))).join(errors.select("bin"), "bin", "left_anti")
    seqs = sequences.groupBy("bin", "locus").agg(*[F.min(F.when(F.col("field") == c, F.col("seq"))).alias(f"_{c}") for c in ("aa", "nt")])
    filled = features.join(seqs, ["bin", "locus"], "left").withColumn("aa", F.coalesce("aa", "_aa")).withColumn("nt", F.coalesce("nt", "_nt")).drop("_aa", "_nt")
    filled = filled.withColumn("aa_length", F.length(F.rtrim(F.regexp_replace("aa", r"\*+$", ""))).cast("long")).withColumn("nt_length", F.length("nt").cast("long"))
    n = filled.groupBy("bin").agg(F.count("*").alias("features"))
    sources = given.withColumn("source", F.lit("json")).unionByName(tables.select("bin").distinct().join(given, "bin", "left_anti").withColumn("source", F.lit("table")))
    return filled, bins.select("bin").join(sources, "bin", "left").join(n, "bin", "left").join(errors, "bin", "left").select("bin", F.coalesce("source", F.lit("none")).alias("source"), F.coalesce("features", F.lit(0)).cast("long").alias("features"), F.coalesce("error", F.lit("")).alias("error"))
