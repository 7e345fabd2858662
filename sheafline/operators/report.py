"""Tables behind a report: feature tables, splits, panels, occupancy, validation, legends, trees, frontiers and sort keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import metrics


def feature_table(contigs: DataFrame, labels: dict[str, Column], coverage: DataFrame, genes: DataFrame, excluded: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """The plotting table of contigs: labels by rank, numbers as text with empty or NA for missing ones, and whether each is retained.

    contigs: contig, length, gc, bin; coverage: contig, mean_depth, covered_fraction; genes: contig, orfs, coding_bp; extra holds
    coordinates by contig.
    """
    from .binning import coding_density, number

    out = excluded.select("contig", F.lit(True).alias("_out")).distinct()
    j = contigs.join(coverage, "contig", "left").join(genes, "contig", "left").join(out, "contig", "left")
    more = []
    if extra is not None:
        more = [c for c in extra.columns if c != "contig"]
        j = j.join(extra, "contig", "left")
    gone = F.coalesce("_out", F.lit(False))
    return j.select(
        F.col("contig").alias("ID"), "length", number(F.col("gc") * 100, 2).alias("GC"), number(F.col("mean_depth"), 4, "").alias("coverage"), number(F.col("covered_fraction"), 4, "").alias("covered_fraction"),
        number(coding_density(), 4).alias("coding_density"), F.coalesce(F.col("orfs").cast("string"), F.lit("NA")).alias("n_cds"), *[c.alias(f"taxon_{r}") for r, c in labels.items()],
        F.when(gone, "excluded").otherwise(F.col("bin")).alias("bin"), F.when(gone, "false").otherwise("true").alias("retained"), *[number(F.col(c), 6, "").alias(c) for c in more],
    )


def provenance(final: DataFrame, preliminary: DataFrame) -> DataFrame:
    """Final contigs (contig, source_record, source_type) with what the preliminary contig they come from had; reassembled ones have none."""
    p = preliminary.withColumnRenamed("contig", "source_record")
    kept = final.withColumn("source_record", F.when(F.col("source_type") == "original", F.col("source_record")))
    return kept.join(p, "source_record", "left")


def split_bins(assignments: DataFrame, sequences: DataFrame, order: list[str]) -> DataFrame:
    """Sequences by the label that a manual split gives them; a sequence that occurs more than once counts where it comes first.

    assignments: id, label; sequences: id, order columns and whatever else.
    """
    rest = [c for c in sequences.columns if c != "id"]
    first = sequences.groupBy("id").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("x")).select("id", "x.*")
    return first.join(assignments.dropDuplicates(["id"]), "id")


def missing_components(evidence: DataFrame, panel: DataFrame) -> DataFrame:
    """bin, pathway and component of what a pathway's panel asks for and a bin was measured for without finding it."""
    return panel.join(evidence.where("value = 0"), "component").select("bin", "pathway", "component")


def rule_models(definitions: DataFrame, rules: DataFrame) -> DataFrame:
    """pathway, component and model of all rules that confirm a component; rules: model, components (an array)."""
    each = rules.select("model", F.explode("components").alias("component"))
    return definitions.join(each, "component", "left").select("pathway", "component", "model")


def updated(rows: DataFrame, values: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows with the fields that values has for their key in the place of their own."""
    v = values.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    j = rows.join(v, key, "left")
    return j.select(*[F.coalesce(f"_{c}", c).alias(c) if c in fields else F.col(c) for c in rows.columns])


def occupancy(alignment: DataFrame, group: str, least: float = 0.8) -> DataFrame:
    """group, position and occupied share of the columns of an alignment that enough members have a letter at; alignment: group, id, seq."""
    n = alignment.groupBy(group).agg(F.count("*").alias("_members"))
    cells = alignment.select(group, F.posexplode(F.split("seq", "")).alias("position", "letter")).where("letter NOT IN ('-', '.', '')")
    per = cells.groupBy(group, "position").agg(F.count("*").alias("held")).join(n, group)
    return per.where(F.col("held") >= F.ceil(F.lit(least) * F.col("_members"))).select(group, F.col("position").cast("long").alias("position"), F.round(F.col("held") / F.col("_members"), 6).alias("share"))


def trimmed(alignment: DataFrame, group: str, least: float = 0.8) -> DataFrame:
    """The alignment's rows with the columns that occupancy() keeps; a group's columns travel with its rows as one sorted list."""
    kept = occupancy(alignment, group, least).groupBy(group).agg(F.array_sort(F.collect_list(F.col("position").cast("int"))).alias("_at"))
    cut = F.array_join(F.transform("_at", lambda p: F.get(F.split("seq", ""), p)), "")
    return alignment.join(kept, group).select(group, "id", cut.alias("seq"))


def markers(members: DataFrame, taxa: int, anchor: str, share: float = 0.8) -> DataFrame:
    """marker and members of the markers that enough genomes have, the anchor among them; members: marker, genome."""
    per = members.groupBy("marker").agg(F.countDistinct("genome").alias("members"), F.max((F.col("genome") == anchor).cast("int")).alias("_anchor"))
    return per.where((F.col("members") >= max(3, -(-taxa * int(share * 100) // 100))) & (F.col("_anchor") == 1)).select("marker", "members")


def shown_bins(counts: DataFrame, group: str, value: str) -> DataFrame:
    """The rows of groups of which any value is above zero."""
    some = counts.groupBy(group).agg(F.max(value).alias("_most")).where("_most > 0").select(group)
    return counts.join(some, group, "left_semi")


def legend(rows: DataFrame, column: str, most: int = 14, other: str = "other") -> DataFrame:
    """The most common values with their numbers, and all others together."""
    per = rows.groupBy(F.coalesce(F.col(column), F.lit("NA")).alias("label")).agg(F.count("*").cast("long").alias("n"))
    top = per.orderBy(F.desc("n"), "label").limit(most).select(F.col("label").alias("_top"))  # a legend's entries
    named = per.join(F.broadcast(top), F.col("label") == F.col("_top"), "left")
    return named.groupBy(F.when(F.col("_top").isNull(), other).otherwise(F.col("label")).alias("label")).agg(F.sum("n").alias("n"))


def sort_key(column: Column) -> list[Column]:
    """Numbers before texts, in their order, texts without regard to case, missing ones last."""
    x = column.try_cast("double")
    return [column.isNull() | (column == ""), x.isNull(), x, F.lower(column), column]


def numeric_columns(rows: DataFrame, columns: list[str], share: float = 0.5) -> DataFrame:
    """column, values, numbers and whether a column counts as numeric: a share of its rows, one at least, are numbers."""
    counts = rows.agg(F.count("*").alias("_n"), *[F.count(F.col(c).try_cast("double")).alias(c) for c in columns])
    long = counts.select("_n", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("numbers")) for c in columns])).alias("x"))
    return long.select("x.column", F.col("_n").alias("rows"), "x.numbers", (F.col("x.numbers") >= F.greatest(F.lit(1.0), F.lit(share) * F.col("_n"))).alias("numeric"))


def digest(*columns: Column) -> Column:
    """Fingerprint of a record: SHA-256 of its fields as JSON, in their order."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def radii(rows: DataFrame, group: str, distance: str, factor: float = 1.5, floor: float = 0.75) -> DataFrame:
    """group and radius: the 95th percentile of its members' distances times a factor, and not under a floor."""
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(distance))).withColumn("_n", F.count("*").over(Window.partitionBy(group)))
    at = F.lit(0.95) * (F.col("_n") - 1) + 1
    low, high = F.floor(at), F.ceil(at)
    pick = lambda k: F.max(F.when(F.col("_k") == k, F.col(distance)))
    per = ranked.groupBy(group).agg(pick(low).alias("a"), pick(high).alias("b"), F.max(at - low).alias("f"))
    return per.select(group, F.round(F.greatest(F.lit(floor), (F.col("a") + (F.col("b") - F.col("a")) * F.col("f")) * factor), 6).alias("radius"))


def frontier(reads: DataFrame, baits: DataFrame, k: int, least: int) -> DataFrame:
    """Reads that share at least so many different k-mers with the baits, on either strand; both have id and seq.

    The k-mers of the baits are distinct before the join, so a common one meets a read once.
    """
    from .graph import reverse_complement

    grams = lambda s: F.expr(f"CASE WHEN length({s}) >= {k} THEN array_distinct(transform(sequence(1, length({s}) - {k - 1}), i -> substring({s}, i, {k}))) END")
    of = lambda df: df.select("id", F.explode(grams("seq")).alias("gram")).where(~F.col("gram").contains("N"))
    both = baits.select("id", F.explode(F.array("seq", reverse_complement(F.col("seq")))).alias("seq"))
    known = of(both).select("gram").distinct()
    met = of(reads).join(known, "gram", "left_semi").groupBy("id").agg(F.count("*").cast("long").alias("shared"))
    return met.where(F.col("shared") >= least)


def invalid_rules(rules: DataFrame, components: DataFrame, pathways: DataFrame) -> DataFrame:
    """model and problem of rules that name an unknown component, and pathway and problem of pathways that do: empty if all is well.

    rules: model, components; pathways: pathway, components; components: component.
    """
    known = components.select("component").distinct()
    asked = rules.select(F.col("model").alias("name"), F.lit("rule").alias("kind"), F.explode("components").alias("component")).unionByName(pathways.select(F.col("pathway").alias("name"), F.lit("pathway").alias("kind"), F.explode("components").alias("component")))
    unknown = asked.join(known, "component", "left_anti").select("name", "kind", F.concat(F.lit("unknown component "), "component").alias("problem"))
    twice = rules.groupBy("model").count().where("count > 1").select(F.col("model").alias("name"), F.lit("rule").alias("kind"), F.lit("given twice").alias("problem"))
    return unknown.distinct().unionByName(twice)


def coverage_classes(rows: DataFrame, group: str, value: str) -> DataFrame:
    """group with its number of rows without coverage, and the median of the others."""
    zero = rows.groupBy(group).agg(F.sum((F.coalesce(value, F.lit(0)) == 0).cast("int")).cast("long").alias("hidden"))
    return zero.join(metrics.exact_median(rows.where(F.col(value) > 0), [group], value), group, "left")
