"""Decisions on contigs and bins: prefilter, exclusions, eligibility, refinement, annotation, replacement, inheritance and order.

Rules are column expressions over named columns, joins are on contig or bin; each rule's order of tests is part of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .partition import UNCLASSIFIED
from .select import seeded_sample

PROKARYOTIC = ("bacteria", "archaea", "prokarya")
RANKS = ["domain", "kingdom", "phylum", "class", "order", "family", "genus", "species"]


def coding(orfs: DataFrame) -> DataFrame:
    """contig, orfs and coding_bp: number and summed spans of the open reading frames (start and stop included)."""
    return orfs.groupBy("contig").agg(F.count("*").cast("long").alias("orfs"), F.sum(F.abs(F.col("stop") - F.col("start")) + 1).cast("long").alias("coding_bp"))


def coding_density() -> Column:
    """coding_bp over length, 1 at most; null for a contig without genes."""
    return F.when(F.col("coding_bp").isNotNull(), F.least(F.lit(1.0), F.col("coding_bp") / F.col("length")))  # least() passes over nulls


def prefilter(contigs: DataFrame, genes: DataFrame, rescue: float, rescue_eukarya: bool = False, audit: float = 0.0) -> DataFrame:
    """Adds coding_density, orfs, decision and audited; contigs: contig, length, tiara (null: unknown); genes: coding().

    Prokaryotic contigs are searched; others only if dense enough, eukaryotic ones only if rescued. Of the skipped ones with
    genes a seeded share is audited.
    """
    j = contigs.join(genes, "contig", "left").withColumn("tiara", F.coalesce("tiara", F.lit("unknown"))).withColumn("orfs", F.coalesce("orfs", F.lit(0)))
    density = F.when(F.col("length") > 0, F.least(F.lit(1.0), F.coalesce("coding_bp", F.lit(0)) / F.col("length"))).otherwise(0.0)
    first = F.when(F.col("tiara").isin(*PROKARYOTIC), "search")
    if not rescue_eukarya:
        first = first.when(F.col("tiara") == "eukarya", "skip_eukarya")
    decision = first.when(density > rescue, "search_rescued_coding_density").when(F.col("tiara") == "organelle", "skip_organelle").when(F.col("tiara") == "eukarya", "skip_eukarya").otherwise("skip_unknown")
    skipped = decision.startswith("skip") & (F.col("orfs") > 0)
    return j.withColumn("coding_density", F.round(density, 4)).withColumn("decision", decision).withColumn("audited", skipped & seeded_sample(F.col("contig"), audit))


def selected() -> Column:
    """Contigs that are searched."""
    return F.col("decision").startswith("search") | F.col("audited")


def _removed(pre: DataFrame, calls: DataFrame) -> DataFrame:
    """What the prefilter takes away, with the domain that an audit found."""
    return pre.where(F.col("decision").isin("skip_eukarya", "skip_organelle")).select("contig", "length", "audited").join(calls.select("contig", "domain"), "contig", "left")


def exclusions(pre: DataFrame, calls: DataFrame, kingdoms: tuple[str, ...]) -> DataFrame:
    """contig and why for what is left out of the bins: by kingdom, or by the prefilter unless an audited contig is prokaryotic.

    calls: contig, domain, kingdom. Unknown contigs are never left out by the prefilter.
    """
    by_kingdom = calls.where(F.col("kingdom").isin(*kingdoms)).select("contig", F.lit("kingdom").alias("why"))
    removed = _removed(pre, calls)
    saved = F.col("audited") & F.coalesce(F.col("domain").isin("Bacteria", "Archaea"), F.lit(False))
    return by_kingdom.unionByName(removed.where(~saved).select("contig", F.lit("prefilter").alias("why"))).groupBy("contig").agg(F.array_join(F.array_sort(F.collect_set("why")), ";").alias("why"))


def audit_estimate(pre: DataFrame, calls: DataFrame) -> DataFrame:
    """One row: audited removed contigs, prokaryotic ones, and their share of length times the removed length."""
    removed = _removed(pre, calls)
    good = F.col("audited") & F.coalesce(F.col("domain").isin("Bacteria", "Archaea"), F.lit(False))
    bp = lambda c: F.coalesce(F.sum(F.when(c, F.col("length"))), F.lit(0))
    n = lambda c: F.sum(c.cast("int")).cast("long")
    return removed.agg(n(F.col("audited")).alias("audited"), n(good).alias("prokaryotic"), F.round(bp(good) / F.greatest(bp(F.col("audited")), F.lit(1)) * F.sum("length"), 2).alias("estimated_bp"))


def eligibility(members: DataFrame, domains: tuple[str, ...], most_bp: int) -> DataFrame:
    """bin, contigs, bp, domain (the one with most length) and skip (why a bin is not reassembled, null if it is).

    members: bin, length, domain. Unclassified contigs are no bin; catch-alls named unclassified_ are mixed.
    """
    held = members.where(F.col("bin") != UNCLASSIFIED)
    size = held.groupBy("bin", "domain").agg(F.sum("length").alias("bp"), F.count("*").alias("n"))
    per = size.groupBy("bin").agg(F.sum("bp").alias("bp"), F.sum("n").alias("contigs"), F.min_by("domain", F.struct(-F.col("bp"), F.col("domain"))).alias("domain"))
    mixed = F.col("bin").startswith("unclassified_")
    skip = F.when(mixed, "catch_all").when(~F.col("domain").isin(*domains), "domain").when(F.col("bp") > most_bp, "size")
    return per.select("bin", "contigs", "bp", F.when(mixed, "mixed").otherwise(F.col("domain")).alias("domain"), skip.alias("skip"))


def triage(rows: DataFrame, least_length: int = 3000, least_density: float = 0.35) -> Column:
    """Call by coding density; short contigs are uncertain."""
    return F.when(F.col("length") < least_length, "uncertain_short_retained").when(F.col("coding_density") < least_density, "eukaryotic_like_quarantined").otherwise("prokaryotic_like_retained")


def refine(rows: DataFrame, least_length: int, least_support: float, least_references: int, z: float, gc_floor: float, depth_floor: float) -> DataFrame:
    """contig, taxon and status by robust centres of GC and log2 depth among each taxon's reference contigs.

    rows: contig, taxon, length, support, gc, depth (null if unknown). Medians are exact; a taxon's references meet by
    distinct value, counted first.
    """
    ref = (F.col("length") >= least_length) & (F.col("support") >= least_support) & F.col("depth").isNotNull()
    named = rows.where(F.col("taxon") != UNCLASSIFIED)
    refs = named.where(ref)
    first = refs.groupBy("taxon").agg(F.count("*").alias("n"), F.median("gc").alias("gc_center"), F.median(F.when(F.col("depth") > 0, F.col("depth"))).alias("positive"))
    first = first.withColumn("floor", F.greatest(F.lit(0.01), F.col("positive") * 0.01))
    logged = refs.join(first, "taxon").withColumn("x", F.log2(F.col("depth") + F.col("floor")))
    second = logged.groupBy("taxon").agg(F.median("x").alias("x_center"), F.median(F.abs(F.col("gc") - F.col("gc_center"))).alias("gc_mad"))
    third = logged.join(second, "taxon").groupBy("taxon").agg(F.median(F.abs(F.col("x") - F.col("x_center"))).alias("x_mad"))
    j = rows.join(first, "taxon", "left").join(second, "taxon", "left").join(third, "taxon", "left")
    gc_out = F.abs(F.col("gc") - F.col("gc_center")) > F.greatest(F.lit(gc_floor), F.lit(z * 1.4826) * F.col("gc_mad"))
    x_out = F.abs(F.log2(F.col("depth") + F.col("floor")) - F.col("x_center")) > F.greatest(F.lit(depth_floor), F.lit(z * 1.4826) * F.col("x_mad"))
    status = (
        F.when(F.col("taxon") == UNCLASSIFIED, "unclassified_not_refined").when(F.coalesce("n", F.lit(0)) < least_references, "insufficient_reference_contigs").when(F.col("positive").isNull(), "no_coverage_signal")
        .when(F.col("length") < least_length, "short_contig_not_refined").when(F.col("depth").isNull(), "coverage_unavailable")
        .when(gc_out & x_out, "joint_gc_coverage_outlier").when(gc_out, "gc_only_outlier_retained").when(x_out, "coverage_only_outlier_retained").otherwise("coherent")
    )
    return j.select("contig", "taxon", status.alias("status"))


def demote(calls: DataFrame, outliers: DataFrame, rank: str, ranks: list[str] = RANKS) -> DataFrame:
    """calls (contig, rank, taxon, support) with the outliers' names at a rank and below it Unclassified; supports stay."""
    low = ranks[ranks.index(rank) :] if rank in ranks else []
    marked = calls.join(outliers.select("contig", F.lit(True).alias("_out")).distinct(), "contig", "left")
    return marked.withColumn("taxon", F.when(F.col("_out") & F.col("rank").isin(*low), UNCLASSIFIED).otherwise(F.col("taxon"))).drop("_out")


def drop_small(members: DataFrame, least_bp: int, least_contigs: int = 1) -> DataFrame:
    """contig and bin: bins that are too small become Unclassified, once and for all; members: contig, bin, length."""
    size = members.groupBy("bin").agg(F.sum("length").alias("_bp"), F.count("*").alias("_n"))
    small = (F.col("_bp") < least_bp) | (F.col("_n") < least_contigs)
    return members.join(size, "bin").select("contig", F.when(small, UNCLASSIFIED).otherwise(F.col("bin")).alias("bin"), "length")


def finest(ranks: list[str], asked: str | None = None, order: list[str] = RANKS) -> str | None:
    """The rank asked for if it is there, else the finest known one."""
    return asked if asked in ranks else next((r for r in reversed(order) if r in ranks), None)


def rank_place(rank: Column, order: list[str] = RANKS) -> Column:
    """Place of a rank from the top; unknown ones last."""
    return F.coalesce(F.try_element_at(F.create_map(*[x for i, r in enumerate(order) for x in (F.lit(r), F.lit(i))]), rank), F.lit(99))


def classification(contigs: DataFrame, calls: DataFrame, coverage: DataFrame, genes: DataFrame, pre: DataFrame, excluded: DataFrame, ranks: list[str]) -> DataFrame:
    """The wide table of contigs: one row each, calls of all ranks beside one another, texts and NA as in the table's file form.

    contigs: contig, length, gc; calls: contig, rank, taxon, support; coverage: contig, mean_depth, covered_fraction.
    """
    wide = calls.groupBy("contig").agg(*[x for r in ranks for x in (F.max(F.when(F.col("rank") == r, F.col("taxon"))).alias(r), F.max(F.when(F.col("rank") == r, F.col("support"))).alias(f"{r}_support"))])
    out = excluded.groupBy("contig").agg(F.max(F.col("why").contains("kingdom")).alias("_kingdom"), F.max(F.col("why").contains("prefilter")).alias("_prefilter"))
    j = contigs.join(wide, "contig", "left").join(coverage, "contig", "left").join(genes, "contig", "left").join(pre.select("contig", "decision", "tiara", "audited"), "contig", "left").join(out, "contig", "left")
    no = lambda c: F.coalesce(c, F.lit(False))
    return j.select(
        "contig", "length", number(F.col("gc") * 100, 3).alias("gc"), number(coding_density(), 5).alias("coding_density"), F.coalesce(F.col("orfs").cast("string"), F.lit("NA")).alias("n_cds"),
        number(F.col("mean_depth"), 5).alias("mean_depth"), number(F.col("covered_fraction"), 5).alias("covered_fraction"), F.coalesce("decision", F.lit("not_evaluated")).alias("triage_call"), no(F.col("_prefilter")).alias("excluded_gene_density"),
        F.coalesce("orfs", F.lit(0)).alias("n_orfs"), *[F.coalesce(r, F.lit(UNCLASSIFIED)).alias(r) for r in ranks], *[F.coalesce(f"{r}_support", F.lit(0.0)).alias(f"{r}_support") for r in ranks],
        no(F.col("_kingdom")).alias("excluded_animal_plant"), F.coalesce("tiara", F.lit("NA")).alias("tiara_class"), no(selected()).alias("searched"),
    )


def number(x: Column, places: int, missing: str | None = "NA") -> Column:
    """A number with so many places, halves to the even digit; what stands for a missing one."""
    return F.when(x.isNull(), F.lit(missing)).otherwise(F.format_string(f"%.{places}f", F.bround(x.cast("double"), places)))


def replaced(originals: DataFrame, accepted: DataFrame) -> DataFrame:
    """Records of the final assembly with where each comes from: accepted bins take the place of the original contigs.

    originals: bin, record; accepted: bin, record.
    """
    kept = originals.join(accepted.select("bin").distinct(), "bin", "left_anti").withColumn("source_type", F.lit("original"))
    return kept.unionByName(accepted.withColumn("source_type", F.lit("reassembled")))


def filled(bins: DataFrame, summary: DataFrame, raw: DataFrame, fields: list[str]) -> DataFrame:
    """Bins with each field from the summary (rank, bin), else from the raw table by qualified name, else by a bin name that is
    found at one rank only. raw has name: rank__bin or bin."""
    only = bins.groupBy("bin").agg(F.countDistinct("rank").alias("_ranks")).where("_ranks = 1").select("bin", F.lit(True).alias("_only"))
    s = summary.select("rank", "bin", *[F.col(f).alias(f"_s_{f}") for f in fields])
    q = raw.select(F.col("name").alias("_q"), *[F.col(f).alias(f"_q_{f}") for f in fields])
    u = raw.select(F.col("name").alias("_u"), *[F.col(f).alias(f"_u_{f}") for f in fields])
    j = bins.join(s, ["rank", "bin"], "left").join(q, F.col("_q") == F.concat_ws("__", "rank", "bin"), "left").join(only, "bin", "left").join(u, (F.col("_u") == F.col("bin")) & F.col("_only"), "left")
    return j.select(*bins.columns, *[F.coalesce(f"_s_{f}", f"_q_{f}", f"_u_{f}").alias(f) for f in fields])


def inherited(contigs: DataFrame, membership: DataFrame, lineages: DataFrame) -> DataFrame:
    """contig with the lineage of its bin; contigs without bin have none."""
    return contigs.join(membership, "contig", "left").join(lineages, "bin", "left")


def owned_records(records: DataFrame, owners: DataFrame) -> DataFrame:
    """Records (bin, contig) of a consolidated assembly; a contig that another bin has adopted is left to that one.

    owners: contig, bin. Rows carry times, how often a contig would be written; more than once is an error for the caller.
    """
    o = owners.select("contig", F.col("bin").alias("_owner"))
    kept = records.join(o, "contig", "left").where(F.col("_owner").isNull() | (F.col("_owner") == F.col("bin"))).drop("_owner")
    taken = owners.join(records.select("bin", "contig"), ["bin", "contig"], "left_anti").select("bin", "contig")
    every = kept.select("bin", "contig").unionByName(taken)
    return every.join(every.groupBy("contig").agg(F.count("*").cast("long").alias("times")), "contig")


def checked(rows: DataFrame, condition: Column, message: str, column: str) -> DataFrame:
    """The rows, with an error at run time where a condition holds."""
    return rows.withColumn(column, F.when(condition, F.raise_error(F.lit(message)).cast(rows.schema[column].dataType)).otherwise(F.col(column)))


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys on the left that the right does not know: unknown bins, missing endpoints, requested bins that are not there."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def refreshed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and the old ones of other keys."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def annotation_plan(bins: DataFrame, metadata: DataFrame, code4: tuple[str, ...], default: int = 11) -> DataFrame:
    """bin, code, code_source and reason (why a bin is not annotated, null if it is).

    bins: bin, contigs, domains and genera (arrays of the names of its contigs); metadata: bin, domain, code.
    """
    j = bins.join(metadata.select("bin", F.col("domain").alias("_domain"), F.col("code").alias("_code")), "bin", "left")
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0))
    four = F.array(*map(F.lit, code4))
    hints = F.array_distinct(F.transform("genera", lambda g: F.when(F.arrays_overlap(words(g), four), 4).otherwise(11)))
    named = F.arrays_overlap(words(F.col("bin")), four) | (hints == F.array(F.lit(4)))
    code = F.coalesce("_code", F.when(named, 4), F.lit(default))
    source = F.when(F.col("_code").isNotNull(), "metadata").when(named, "taxon_hint").otherwise("default")
    domains = F.when(F.col("_domain").isNotNull(), F.array("_domain")).otherwise(F.array_sort(F.array_distinct("domains")))
    reason = (
        F.when((F.col("bin") == UNCLASSIFIED) | F.col("bin").startswith("unclassified_"), "catch_all").when(F.col("contigs") == 0, "empty").when(domains != F.array(F.lit("Bacteria")), F.concat(F.lit("domains:"), F.when(F.size(domains) > 0, F.array_join(domains, ",")).otherwise("unknown")))
        .when((F.size(hints) > 1) & F.col("_code").isNull(), "mixed_codes")
    )
    return j.select("bin", code.alias("code"), source.alias("code_source"), reason.alias("reason"))


def panel(text: Column, names: tuple[str, ...]) -> Column:
    """The one name of a panel that occurs as a word; none, or several, give null."""
    met = F.array_intersect(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0)), F.array(*[F.lit(n.lower()) for n in names]))
    return F.when(F.size(met) == 1, met[0])


def inspected(bins: DataFrame, names: tuple[str, ...], least: float = 10.0) -> DataFrame:
    """Bins that are looked at closely: of the panel, or complete enough, and not the unclassified one."""
    group = panel(F.col("bin"), names)
    return bins.withColumn("group", group).where((F.lower("bin") != "unclassified") & (group.isNotNull() | F.coalesce(F.col("completeness") >= least, F.lit(False))))


def namespaced(retained: DataFrame, others: DataFrame, files: str = "file") -> DataFrame:
    """All records of both; a name that a retained record holds for another sequence gets a prefix from its file's hash.

    retained and others: name, seq; others also name their file. Equal records are one.
    """
    known = retained.select("name", F.col("seq").alias("_seq"))
    j = others.join(known, "name", "left")
    name = F.when(F.col("_seq").isNotNull() & (F.col("_seq") != F.col("seq")), F.concat(F.lit("intermediate_"), F.substring(F.sha2(files, 256), 1, 12), F.lit("_"), F.col("name"))).otherwise(F.col("name"))
    return retained.select("name", "seq").unionByName(j.select(name.alias("name"), "seq")).distinct()


def first_seen(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in order."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("x")).select(*key, "x.*")


def offsets(blocks: DataFrame, group: str, order: str, length: str) -> DataFrame:
    """Adds start and end of each block within its group, counted from 1."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("end", F.sum(length).over(w)).withColumn("start", F.col("end") - F.col(length) + 1)


def widest_gap(genes: DataFrame, group: list[str], place: str) -> DataFrame:
    """The most places left out between neighbouring genes of each window."""
    w = Window.partitionBy(*group).orderBy(place)
    return genes.withColumn("_gap", F.lead(place).over(w) - F.col(place) - 1).groupBy(*group).agg(F.coalesce(F.max("_gap"), F.lit(0)).cast("long").alias("max_gap"), F.count("*").cast("long").alias("genes"))


def lineage_weights(calls: DataFrame, closure: DataFrame, group: str, share: float = 0.7) -> DataFrame:
    """group, taxid and share of the named length: the deepest taxon that holds a share of it. calls: group, length, taxid (null if none)."""
    named = calls.where("taxid IS NOT NULL")
    total = named.groupBy(group).agg(F.sum("length").alias("named"))
    depth = closure.groupBy(F.col("node").alias("ancestor")).agg(F.max("distance").alias("depth"))
    held = named.groupBy(group, "taxid").agg(F.sum("length").alias("bp")).join(closure, F.col("taxid") == F.col("node")).groupBy(group, "ancestor").agg(F.sum("bp").alias("bp")).join(total, group)
    deep = held.where(F.col("bp") >= F.lit(share) * F.col("named")).join(depth, "ancestor")
    return deep.groupBy(group).agg(F.min_by(F.struct("ancestor", F.round(F.col("bp") / F.col("named"), 6).alias("support")), F.struct(-F.col("depth"), F.col("ancestor"))).alias("x")).select(group, F.col("x.ancestor").alias("taxid"), F.col("x.support").alias("support"))


def annotation_counts(features: DataFrame, group: str) -> DataFrame:
    """Features of each kind, and of the proteins the hypothetical and the named ones."""
    kinds = ["cds", "tRNA", "rRNA", "crispr"]
    cds = F.col("kind") == "cds"
    hypothetical = F.lower("product").contains("hypothetical")
    n = lambda c: F.sum(c.cast("int")).cast("long")
    return features.groupBy(group).agg(*[n(F.col("kind") == k).alias(k.lower()) for k in kinds], n(cds & hypothetical).alias("hypothetical"), n(cds & ~hypothetical).alias("named"), F.count("*").cast("long").alias("features"))


def flag(text: Column) -> Column:
    """true, false or null for words that mean yes, no or nothing known."""
    word = F.lower(F.trim(text))
    return F.when(word.isin("1", "true", "yes", "y", "t"), True).when(word.isin("0", "false", "no", "n", "f"), False)


def locus_tag(*parts: Column) -> Column:
    """MH and twelve hexadecimal digits of a hash."""
    return F.concat(F.lit("MH"), F.upper(F.substring(F.sha2(F.concat_ws("\t", *parts), 256), 1, 12)))


def change(before: Column, after: Column, places: int = 1) -> Column:
    """before and after as text, with the difference; NA where one is unknown."""
    both = F.concat(number(before, places), F.lit(" -> "), number(after, places), F.lit(" ("), F.format_string(f"%+.{places}f", after - before), F.lit(")"))
    return F.when(before.isNull() | after.isNull(), "NA").otherwise(both)


def per_mbp(contigs: Column, bp: Column) -> Column:
    return F.when(bp > 0, F.round(contigs * 1e6 / bp, 4)).otherwise(0.0)
