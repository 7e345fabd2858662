"""Queries on the decisions about contigs and bins, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import binning, metrics
from ..session import table
from . import taxa
from .shapes import crc_sql, shape, sql

CALL_RANKS = ["domain", "kingdom", "genus"]


def _contigs(spark, d):
    return shape(spark, d, "contigs")


def _pre(spark, d, audit=0.5):
    return binning.prefilter(_contigs(spark, d), binning.coding(shape(spark, d, "orfs")), 0.6, audit=audit)


def q120_coding(spark, d):
    return binning.coding(shape(spark, d, "orfs"))


def q121_prefilter(spark, d):
    return binning.prefilter(_contigs(spark, d), binning.coding(shape(spark, d, "orfs")), 0.6).select("contig", "tiara", "orfs", "coding_density", "decision", "audited")


def q121b_prefilter_rescued(spark, d):
    pre = binning.prefilter(_contigs(spark, d), binning.coding(shape(spark, d, "orfs")), 0.6, rescue_eukarya=True)
    return pre.where(binning.selected()).groupBy("decision").agg(F.count("*").cast("long").alias("contigs"), F.sum("length").cast("long").alias("bp"))


def _audited(spark, d):
    """The prefilter with every second contig audited, so that SQL can follow."""
    return binning.prefilter(_contigs(spark, d), binning.coding(shape(spark, d, "orfs")), 0.6).withColumn("audited", F.col("decision").startswith("skip") & (F.col("orfs") > 0) & (F.col("contig") % 2 == 0))


def q122_exclusions(spark, d):
    return binning.exclusions(_audited(spark, d), _contigs(spark, d).select("contig", "domain", "kingdom"), ("Metazoa", "Viridiplantae"))


def q123_audit_estimate(spark, d):
    return binning.audit_estimate(_audited(spark, d), _contigs(spark, d).select("contig", "domain"))


def q123b_audit_sample(spark, d):
    return _pre(spark, d).groupBy("decision").agg(F.sum(F.col("audited").cast("int")).cast("long").alias("audited"), F.count("*").cast("long").alias("contigs"))


def _members(spark, d):
    bin_ = F.when(F.col("genus") == "Unclassified", "Unclassified").when(F.col("contig") % 9 == 0, F.concat(F.lit("unclassified_"), "domain")).otherwise(F.col("genus"))
    return _contigs(spark, d).select("contig", bin_.alias("bin"), "length", "domain")


def q124_eligibility(spark, d):
    return binning.eligibility(_members(spark, d), ("Bacteria", "Archaea"), 800_000)


def q125_triage(spark, d):
    pre = binning.prefilter(_contigs(spark, d), binning.coding(shape(spark, d, "orfs")), 0.6)
    called = pre.withColumn("call", binning.triage(pre))
    kept = shape(spark, d, "orfs").join(called.where("call = 'eukaryotic_like_quarantined'").select("contig"), "contig", "left_anti")
    per = kept.groupBy("contig").agg(F.count("*").cast("long").alias("candidates"))
    return called.select("contig", "call").join(per, "contig", "left").select("contig", "call", F.coalesce("candidates", F.lit(0)).alias("candidates"))


def _refined(spark, d):
    return binning.refine(_contigs(spark, d).withColumnRenamed("genus", "taxon"), 5000, 0.2, 12, 1.5, 0.03, 0.4)


def q126_refinement(spark, d):
    return _refined(spark, d)


def _calls(spark, d):
    c = _contigs(spark, d)
    return c.select("contig", F.explode(F.array(*[F.struct(F.lit(r).alias("rank"), F.col(r).alias("taxon"), (F.col("support") + k).alias("support")) for k, r in enumerate(CALL_RANKS)])).alias("x")).select("contig", "x.*")


def q127_demotion(spark, d):
    out = _refined(spark, d).where("status = 'joint_gc_coverage_outlier'")
    return binning.demote(_calls(spark, d), out, "kingdom")


def q128_small_bins(spark, d):
    kept = binning.drop_small(_members(spark, d).select("contig", "bin", "length"), 200_000, 30)
    return kept.groupBy("bin").agg(F.count("*").cast("long").alias("contigs"), F.sum("length").cast("long").alias("bp"))


def q129_classification(spark, d):
    c = _contigs(spark, d)
    cov = c.where("depth IS NOT NULL").select("contig", F.col("depth").alias("mean_depth"), F.least(F.lit(1.0), F.col("depth") / 16).alias("covered_fraction"))
    pre = _audited(spark, d).where("contig % 10 <> 3")
    out = binning.exclusions(pre, c.select("contig", "domain", "kingdom"), ("Metazoa", "Viridiplantae"))
    return binning.classification(c.select("contig", "length", "gc"), _calls(spark, d).where("contig % 6 <> 1"), cov, binning.coding(shape(spark, d, "orfs")), pre, out, CALL_RANKS)


def q130_replaced(spark, d):
    o = shape(spark, d, "originals").select("bin", F.col("contig").alias("record"))
    accepted = shape(spark, d, "paf").where("hi > lo").select(F.concat(F.lit("b"), F.col("qname") % 25).alias("bin"), F.col("lo").alias("record")).where("record % 50 = 0 AND bin IN ('b1', 'b4', 'b9')").distinct()
    return binning.replaced(o, accepted)


def q131_filled(spark, d):
    """Quality of bins from three sources in order."""
    bins = shape(spark, d, "bins").select("rank", "bin").unionByName(shape(spark, d, "bins").where("region = 2").select(F.lit("class").alias("rank"), "bin"))
    known = shape(spark, d, "bins").select("rank", "bin", F.when(F.col("contigs") % 3 != 0, F.col("completeness")).alias("completeness"), "contamination").where("contigs % 4 <> 1")
    raw = shape(spark, d, "bins").select(F.when(F.col("contigs") % 2 == 0, F.concat_ws("__", "rank", "bin")).otherwise(F.col("bin")).alias("name"), (F.coalesce("completeness", F.lit(0.0)) + 1).alias("completeness"), F.col("contigs").cast("double").alias("contamination"))
    return binning.filled(bins, known, raw, ["completeness", "contamination"])


def q132_inherited(spark, d):
    c = _contigs(spark, d)
    lineages = _members(spark, d).where("bin NOT LIKE '%nclassified%'").groupBy("bin").agg(F.min("domain").alias("domain"))
    return binning.inherited(c.select("contig"), _members(spark, d).where("contig % 4 <> 0").select("contig", "bin"), lineages)


def q133_owned_records(spark, d):
    rec = _members(spark, d).where("bin LIKE 'g%'").select("bin", "contig")
    owners = rec.where("contig % 5 = 0").select("contig", F.when(F.col("contig") % 10 == 0, "g1").otherwise(F.col("bin")).alias("bin"))
    return binning.owned_records(rec, owners)


def q134_unknown_bins(spark, d):
    """Requested bins that are not there, and link ends without a node."""
    asked = _members(spark, d).select("bin").distinct()
    have = shape(spark, d, "originals").select(F.regexp_replace("bin", "^b", "g").alias("bin")).where("bin <> 'g3'")
    return binning.unmatched(asked, have, ["bin"])


def q135_refreshed(spark, d):
    old = shape(spark, d, "bins").select("rank", "bin", "contigs")
    new = shape(spark, d, "bins").where("region = 1 OR contigs % 6 = 0").select("rank", "bin", "completeness")
    return binning.refreshed(old, new, ["rank"])


def q136_annotation_plan(spark, d):
    c = _members(spark, d).join(_contigs(spark, d).select("contig", "genus"), "contig")
    named = F.when(F.col("contig") % 11 == 0, "Mycoplasma bovis").when(F.col("contig") % 13 == 0, "spiro-plasma").otherwise(F.col("genus"))
    rows = c.withColumn("name", F.when(F.col("bin").isin("g2", "g5"), named).otherwise(F.when(F.col("bin") == "g7", "Mycoplasma").otherwise(F.col("genus"))))
    bacterial = (F.col("domain") == "Bacteria") & (F.col("name") != "Unclassified")
    bins = rows.groupBy("bin").agg(F.count("*").alias("contigs"), F.collect_set(F.when(F.col("domain") != "Unclassified", F.col("domain"))).alias("domains"), F.collect_set(F.when(bacterial, F.col("name"))).alias("genera"))
    meta = shape(spark, d, "bins").select(F.regexp_replace("bin", "NATION_", "g").alias("bin"), F.when(F.col("contigs") > 17, "Bacteria").alias("domain"), F.when(F.col("contigs") % 6 == 0, F.lit(4)).alias("code")).where("contigs % 3 = 0")
    return binning.annotation_plan(bins, meta, ("mycoplasma", "spiroplasma"))


def q137_inspected(spark, d):
    part = table(spark, d, "part").select(F.concat_ws("_", "p_name", "p_partkey").alias("bin"), F.when(F.col("p_size") > 10, F.col("p_size").cast("double")).alias("completeness"))
    return binning.inspected(part.withColumn("bin", F.translate("bin", "_", "-")), ("ring", "steel", "small"), 30.0).select("bin", "group")


def q138_namespaced(spark, d):
    docs = table(spark, d, "documents")
    kept = docs.select(F.concat(F.lit("k"), F.col("doc_id") % 300).alias("name"), F.sha2("text", 256).alias("seq"), "doc_id").where("doc_id < 300").drop("doc_id")
    other = docs.select(F.concat(F.lit("k"), F.col("doc_id") % 400).alias("name"), F.sha2("text", 256).alias("seq"), F.col("source").alias("file"))
    return binning.namespaced(kept, other)


def q139_first_seen(spark, d):
    line = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", F.floor("l_extendedprice").cast("long").alias("price"))
    return binning.first_seen(line, ["l_orderkey", "l_suppkey"], ["l_linenumber", "l_partkey", "price"])


def q140_offsets(spark, d):
    line = table(spark, d, "orders").select(F.col("o_custkey").alias("genome"), F.col("o_orderkey").alias("marker"), F.floor(F.col("o_totalprice") / 1000).cast("long").alias("length"))
    return binning.offsets(line, "genome", "marker", "length").select("genome", "marker", "start", "end")


def q141_widest_gap(spark, d):
    o = shape(spark, d, "orfs").select("contig", "strand", "orf")
    return binning.widest_gap(o, ["contig", "strand"], "orf")


def q142_lineage_weights(spark, d):
    calls = table(spark, d, "customer").select(F.concat(F.lit("b"), F.col("c_custkey") % 50).alias("bin"), (F.floor(F.abs("c_acctbal")) + 1).cast("long").alias("length"), F.when(F.col("c_nationkey") % 6 != 0, F.col("c_nationkey") % 3 + 2000).cast("long").alias("taxid"))
    return binning.lineage_weights(calls, taxa._closure(spark, d), "bin")


def q143_annotation_counts(spark, d):
    return binning.annotation_counts(shape(spark, d, "features"), "contig")


def q144_feature_filter(spark, d):
    """Features of a kind and text, with flags, locus tags and ends."""
    f = shape(spark, d, "features").where((F.col("kind") == "cds") & F.lower("product").contains("kinase"))
    return f.select("locus", binning.locus_tag(F.col("contig").cast("string"), F.col("locus").cast("string")).alias("tag"), binning.flag(F.element_at(F.array(*map(F.lit, ["yes", "No", " TRUE ", "0", "n/a"])), (F.col("locus") % 5 + 1).cast("int"))).alias("partial"))


def q145_bin_order(spark, d):
    """Bins with their place: by rank, unclassified last, the longest first; pages of the list follow it."""
    b = shape(spark, d, "bins").withColumn("place", binning.rank_place(F.col("rank")))
    from pyspark.sql import Window

    w = Window.orderBy("place", F.lower("bin").contains("unclassified"), F.desc("bp"), "bin")  # one row for each bin of a report
    return b.select("rank", "bin", F.row_number().over(w).cast("long").alias("row"), "place")


def q146_dashboard_filter(spark, d):
    """Bins of a rank and set, with quality, the best first."""
    b = shape(spark, d, "bins")
    passed = F.coalesce((F.col("completeness") >= 70) & (F.col("contamination") <= 10), F.lit(False))
    kept = b.where(F.col("rank").isin("genus", "order") & (F.col("bp") > 0))
    return kept.orderBy(F.col("completeness").desc_nulls_last(), "bin").select("bin", "rank", passed.alias("passed"), binning.per_mbp(F.col("contigs"), F.col("bp")).alias("per_mbp"))


def q147_changes(spark, d):
    from . import reads

    r = reads._before_after(spark, d)
    return r.select("bin", binning.change(F.col("b_completeness"), F.col("a_completeness")).alias("completeness"), binning.change(F.col("b_contamination"), F.col("a_contamination"), 2).alias("contamination"), binning.number(F.col("a_bp") / F.col("b_bp"), 3).alias("ratio"))


def q148_bin_metrics(spark, d):
    """N50, L50, contigs for each Mbp, GC of the named letters and length-weighted depth of each bin."""
    m = _members(spark, d).join(_contigs(spark, d).select("contig", "gc", "depth"), "contig")
    nx = metrics.nx_lx(m, ["bin"], "length")
    per = m.groupBy("bin").agg(F.count("*").alias("contigs"), F.sum("length").alias("bp"), F.round(F.sum(F.col("length") * F.col("gc")) / F.sum("length") * 100, 4).alias("gc"), F.round(F.sum(F.col("length") * F.coalesce("depth", F.lit(0.0))) / F.sum("length"), 4).alias("coverage"))
    return per.join(nx, "bin").select("bin", "contigs", "bp", "gc", "coverage", "n50", "l50", binning.per_mbp(F.col("contigs"), F.col("bp")).alias("per_mbp"))


def q149_sample_ranks(spark, d):
    """Summary of each sample and rank: bins, medians, the most fragmented bin; and the matrix of bins by sample with zeros."""
    o = shape(spark, d, "originals").join(shape(spark, d, "bins").select(F.regexp_replace("bin", "NATION_", "b").alias("bin"), "rank"), "bin")
    per = o.groupBy((F.col("contig") % 4).alias("sample"), "rank", "bin").agg(F.count("*").alias("contigs"), F.sum("length").alias("bp"))
    return per.groupBy("sample", "rank").agg(F.count("*").cast("long").alias("bins"), F.median("bp").alias("median_bp"), F.median("contigs").alias("median_contigs"), F.min_by("bin", F.struct(-F.col("contigs"), F.col("bin"))).alias("most_fragmented"))


def q150_sample_matrix(spark, d):
    o = shape(spark, d, "originals").join(shape(spark, d, "bins").select(F.regexp_replace("bin", "NATION_", "b").alias("bin"), "rank"), "bin")
    per = o.groupBy(F.concat_ws("::", "rank", "bin").alias("bin")).pivot("domain", ["Archaea", "Bacteria", "Eukaryota"]).agg(F.sum("length"))
    return per.fillna(0, ["Archaea", "Bacteria", "Eukaryota"])


def q151_complete_depth(spark, d):
    """Length-weighted depth of bins of which every contig has one, with the median of its group beside it."""
    m = _members(spark, d).join(_contigs(spark, d).select("contig", "depth"), "contig")
    per = m.groupBy("bin", "domain").agg(F.when(F.count("*") == F.count("depth"), F.round(F.sum(F.col("length") * F.col("depth")) / F.sum("length"), 4)).alias("depth"), F.sum("length").alias("bp"))
    ref = per.groupBy("domain").agg(F.median("bp").alias("group_median"))
    return per.join(ref, "domain", "left").select("bin", "domain", "depth", "group_median")


def q152_unused_candidates(spark, d):
    """Named contigs outside all bins that are kept and whose name belongs to a panel."""
    c = _contigs(spark, d)
    used = _members(spark, d).where("contig % 3 <> 0").select("contig")
    return c.where("genus <> 'Unclassified' AND kingdom = 'Unclassified'").join(used, "contig", "left_anti").where(F.col("genus").isin("g1", "g4", "g8")).select("contig", "genus")


def q153_mate_files(spark, d):
    """Pairs of files by sample: complete ones, and what is missing or given twice."""
    files = table(spark, d, "conversations").select(F.concat(F.lit("s"), F.col("conv_id")).alias("sample"), F.when(F.col("role") == "user", "R1").otherwise("R2").alias("mate"))
    per = files.groupBy("sample").agg(*[F.sum((F.col("mate") == m).cast("int")).alias(m) for m in ("R1", "R2")])
    return per.select("sample", F.when((F.col("R1") == 1) & (F.col("R2") == 1), "paired").when((F.col("R1") > 1) | (F.col("R2") > 1), "ambiguous").otherwise("incomplete").alias("status"))


def q154_scatter(spark, d):
    """Points of a report: long enough and with a coordinate, the longest first, and whether others were left out."""
    c = _contigs(spark, d).where((F.col("length") >= 2000) & F.coalesce("depth", F.when(F.col("contig") % 3 == 0, F.col("gc"))).isNotNull())
    total = c.agg(F.count("*").alias("total"))
    top = c.orderBy(F.desc("length"), "contig").limit(500)  # the report's most points
    return top.join(F.broadcast(total)).select("contig", "length", (F.col("total") > 500).alias("trimmed"))


def q155_record_counts(spark, d):
    docs = table(spark, d, "documents")
    return docs.groupBy("source").agg(F.count("*").cast("long").alias("records"), F.sum(F.coalesce(F.col("text").contains("circular=true") | F.col("text").contains("the "), F.lit(False)).cast("int")).cast("long").alias("marked"))


_PRE = f"""{sql("contigs", "orfs")}, cod AS (SELECT contig, count(*) AS orfs, CAST(sum(abs(stop - start) + 1) AS BIGINT) AS coding_bp FROM orfs GROUP BY 1),
dens AS (SELECT c.contig, length, coalesce(tiara, 'unknown') AS tiara, domain, genus, kingdom, gc, depth, coalesce(orfs, 0) AS orfs, coding_bp, least(1.0, CAST(coalesce(coding_bp, 0) AS DOUBLE) / length) AS density FROM contigs c LEFT JOIN cod ON cod.contig = c.contig),
pre AS (SELECT *, CASE WHEN tiara IN ('bacteria','archaea','prokarya') THEN 'search' WHEN tiara = 'eukarya' THEN 'skip_eukarya' WHEN density > 0.6 THEN 'search_rescued_coding_density' WHEN tiara = 'organelle' THEN 'skip_organelle' ELSE 'skip_unknown' END AS decision FROM dens),
aud AS (SELECT *, decision LIKE 'skip%' AND orfs > 0 AND contig % 2 = 0 AS audited FROM pre),
excl AS (SELECT contig, 'kingdom' AS why FROM contigs WHERE kingdom IN ('Metazoa','Viridiplantae') UNION ALL SELECT contig, 'prefilter' FROM aud WHERE decision IN ('skip_eukarya','skip_organelle') AND NOT (audited AND domain IN ('Bacteria','Archaea')))"""
_MEMBERS = "members AS (SELECT contig, CASE WHEN genus = 'Unclassified' THEN 'Unclassified' WHEN contig % 9 = 0 THEN concat('unclassified_', domain) ELSE genus END AS bin, length, domain, genus, gc, depth FROM contigs)"
_M = f"{sql('contigs')}, {_MEMBERS}"
_REFINE = f"""{sql("contigs")}, refs AS (SELECT * FROM contigs WHERE genus <> 'Unclassified' AND length >= 5000 AND support >= 0.2 AND depth IS NOT NULL),
f1 AS (SELECT genus, count(*) AS n, median(gc) AS gcc, median(CASE WHEN depth > 0 THEN depth END) AS pos FROM refs GROUP BY 1), f2 AS (SELECT *, greatest(0.01, pos * 0.01) AS floor_ FROM f1),
x AS (SELECT refs.genus, gc, gcc, log2(depth + floor_) AS x FROM refs JOIN f2 USING (genus)), s AS (SELECT genus, median(x) AS xc, median(abs(gc - gcc)) AS gm FROM x GROUP BY 1), t AS (SELECT genus, median(abs(x - xc)) AS xm FROM x JOIN s USING (genus) GROUP BY 1),
o AS (SELECT c.*, n, pos, abs(gc - gcc) > greatest(0.03, 1.5 * 1.4826 * gm) AS go, abs(log2(depth + floor_) - xc) > greatest(0.4, 1.5 * 1.4826 * xm) AS xo FROM contigs c LEFT JOIN f2 USING (genus) LEFT JOIN s USING (genus) LEFT JOIN t USING (genus)),
refined AS (SELECT contig, genus AS taxon, CASE WHEN genus = 'Unclassified' THEN 'unclassified_not_refined' WHEN coalesce(n, 0) < 12 THEN 'insufficient_reference_contigs' WHEN pos IS NULL THEN 'no_coverage_signal' WHEN length < 5000 THEN 'short_contig_not_refined' WHEN depth IS NULL THEN 'coverage_unavailable'
  WHEN go AND xo THEN 'joint_gc_coverage_outlier' WHEN go THEN 'gc_only_outlier_retained' WHEN xo THEN 'coverage_only_outlier_retained' ELSE 'coherent' END AS status FROM o)"""
_ORIG = f"{sql('originals', 'bins')}, named AS (SELECT o.*, rank FROM originals o JOIN bins b ON replace(b.bin, 'NATION_', 'b') = o.bin)"

SQL = {
    "q120_coding": f"WITH {sql('orfs')} SELECT contig, count(*) AS orfs, CAST(sum(abs(stop - start) + 1) AS BIGINT) AS coding_bp FROM orfs GROUP BY 1",
    "q121_prefilter": f"WITH {_PRE} SELECT contig, tiara, orfs, round(density, 4) AS coding_density, decision, false AS audited FROM pre",
    "q121b_prefilter_rescued": f"""WITH {_PRE}, r AS (SELECT length, CASE WHEN tiara IN ('bacteria','archaea','prokarya') THEN 'search' WHEN density > 0.6 THEN 'search_rescued_coding_density' END AS decision FROM dens)
SELECT decision, count(*) AS contigs, CAST(sum(length) AS BIGINT) AS bp FROM r WHERE decision IS NOT NULL GROUP BY 1""",
    "q122_exclusions": f"WITH {_PRE} SELECT contig, string_agg(DISTINCT why, ';' ORDER BY why) AS why FROM excl GROUP BY 1",
    "q123_audit_estimate": f"""WITH {_PRE}, r AS (SELECT length, audited, audited AND domain IN ('Bacteria','Archaea') AS good FROM aud WHERE decision IN ('skip_eukarya','skip_organelle'))
SELECT count(*) FILTER (audited) AS audited, count(*) FILTER (good) AS prokaryotic, round(CAST(coalesce(sum(length) FILTER (good), 0) AS DOUBLE) / greatest(coalesce(sum(length) FILTER (audited), 0), 1) * sum(length), 2) AS estimated_bp FROM r""",
    "q123b_audit_sample": f"WITH {_PRE} SELECT decision, count(*) FILTER (decision LIKE 'skip%' AND orfs > 0 AND {crc_sql('CAST(contig AS VARCHAR)')} < {int(0.5 * 2**32)}) AS audited, count(*) AS contigs FROM pre GROUP BY 1",
    "q124_eligibility": f"""WITH {_M}, s AS (SELECT bin, domain, sum(length) AS bp, count(*) AS n FROM members WHERE bin <> 'Unclassified' GROUP BY ALL), p AS (SELECT bin, CAST(sum(n) AS BIGINT) AS contigs, CAST(sum(bp) AS BIGINT) AS bp, arg_min(domain, (-bp, domain)) AS domain FROM s GROUP BY 1)
SELECT bin, contigs, bp, CASE WHEN starts_with(bin, 'unclassified_') THEN 'mixed' ELSE domain END AS domain, CASE WHEN starts_with(bin, 'unclassified_') THEN 'catch_all' WHEN domain NOT IN ('Bacteria','Archaea') THEN 'domain' WHEN bp > 800000 THEN 'size' END AS skip FROM p""",
    "q125_triage": f"""WITH {_PRE}, t AS (SELECT contig, CASE WHEN length < 3000 THEN 'uncertain_short_retained' WHEN round(density, 4) < 0.35 THEN 'eukaryotic_like_quarantined' ELSE 'prokaryotic_like_retained' END AS call, orfs FROM pre)
SELECT contig, call, CASE WHEN call = 'eukaryotic_like_quarantined' THEN 0 ELSE orfs END AS candidates FROM t""",
    "q126_refinement": f"WITH {_REFINE} SELECT * FROM refined",
    "q127_demotion": f"""WITH {_REFINE}, calls AS (SELECT contig, 'domain' AS rank, domain AS taxon, support + 0 AS support FROM contigs UNION ALL SELECT contig, 'kingdom', kingdom, support + 1 FROM contigs UNION ALL SELECT contig, 'genus', genus, support + 2 FROM contigs)
SELECT contig, rank, CASE WHEN rank <> 'domain' AND contig IN (SELECT contig FROM refined WHERE status = 'joint_gc_coverage_outlier') THEN 'Unclassified' ELSE taxon END AS taxon, support FROM calls""",
    "q128_small_bins": f"""WITH {_M}, s AS (SELECT bin, sum(length) < 200000 OR count(*) < 30 AS small FROM members GROUP BY 1) SELECT CASE WHEN small THEN 'Unclassified' ELSE bin END AS bin, count(*) AS contigs, CAST(sum(length) AS BIGINT) AS bp FROM members JOIN s USING (bin) GROUP BY 1""",
    "q129_classification": f"""WITH {_PRE}, p AS (SELECT * FROM aud WHERE contig % 10 <> 3), e AS (SELECT contig, 'kingdom' AS why FROM contigs WHERE kingdom IN ('Metazoa','Viridiplantae') UNION ALL SELECT contig, 'prefilter' FROM p WHERE decision IN ('skip_eukarya','skip_organelle') AND NOT (audited AND domain IN ('Bacteria','Archaea'))),
k AS (SELECT contig FROM e WHERE why = 'kingdom'), f AS (SELECT contig FROM e WHERE why = 'prefilter')
SELECT a.contig, a.length, printf('%.3f', a.gc * 100) AS gc, CASE WHEN a.coding_bp IS NULL THEN 'NA' ELSE printf('%.5f', a.density) END AS coding_density, CASE WHEN a.coding_bp IS NULL THEN 'NA' ELSE CAST(a.orfs AS VARCHAR) END AS n_cds,
  coalesce(printf('%.5f', a.depth), 'NA') AS mean_depth, coalesce(printf('%.5f', CASE WHEN a.depth IS NOT NULL THEN least(1.0, a.depth / 16) END), 'NA') AS covered_fraction, coalesce(p.decision, 'not_evaluated') AS triage_call, a.contig IN (SELECT contig FROM f) AS excluded_gene_density, a.orfs AS n_orfs,
  CASE WHEN a.contig % 6 <> 1 THEN a.domain ELSE 'Unclassified' END AS domain, CASE WHEN a.contig % 6 <> 1 THEN a.kingdom ELSE 'Unclassified' END AS kingdom, CASE WHEN a.contig % 6 <> 1 THEN a.genus ELSE 'Unclassified' END AS genus,
  CASE WHEN a.contig % 6 <> 1 THEN s.support ELSE 0 END AS domain_support, CASE WHEN a.contig % 6 <> 1 THEN s.support + 1 ELSE 0 END AS kingdom_support, CASE WHEN a.contig % 6 <> 1 THEN s.support + 2 ELSE 0 END AS genus_support,
  a.contig IN (SELECT contig FROM k) AS excluded_animal_plant, coalesce(p.tiara, 'NA') AS tiara_class, coalesce(p.decision LIKE 'search%' OR p.audited, false) AS searched
FROM aud a JOIN contigs s ON s.contig = a.contig LEFT JOIN p ON p.contig = a.contig""",
    "q130_replaced": f"""WITH {sql("originals", "paf")}, acc AS (SELECT DISTINCT concat('b', qname % 25) AS bin, lo AS record FROM paf WHERE hi > lo AND lo % 50 = 0 AND concat('b', qname % 25) IN ('b1','b4','b9'))
SELECT bin, contig AS record, 'original' AS source_type FROM originals WHERE bin NOT IN (SELECT bin FROM acc) UNION ALL SELECT bin, record, 'reassembled' FROM acc""",
    "q131_filled": f"""WITH {sql("bins")}, b AS (SELECT rank, bin FROM bins UNION ALL SELECT 'class', bin FROM bins WHERE region = 2), s AS (SELECT rank, bin, CASE WHEN contigs % 3 <> 0 THEN completeness END AS completeness, contamination FROM bins WHERE contigs % 4 <> 1),
r AS (SELECT CASE WHEN contigs % 2 = 0 THEN rank || '__' || bin ELSE bin END AS name, coalesce(completeness, 0) + 1 AS completeness, CAST(contigs AS DOUBLE) AS contamination FROM bins), n AS (SELECT bin, count(DISTINCT rank) AS k FROM b GROUP BY 1)
SELECT b.rank, b.bin, coalesce(s.completeness, q.completeness, u.completeness) AS completeness, coalesce(s.contamination, q.contamination, u.contamination) AS contamination
FROM b JOIN n USING (bin) LEFT JOIN s ON s.rank = b.rank AND s.bin = b.bin LEFT JOIN r q ON q.name = b.rank || '__' || b.bin LEFT JOIN r u ON u.name = b.bin AND k = 1""",
    "q132_inherited": f"""WITH {_M}, l AS (SELECT bin, min(domain) AS domain FROM members WHERE bin NOT LIKE '%nclassified%' GROUP BY 1), m AS (SELECT contig, bin FROM members WHERE contig % 4 <> 0) SELECT c.contig, m.bin, l.domain FROM contigs c LEFT JOIN m ON m.contig = c.contig LEFT JOIN l ON l.bin = m.bin""",
    "q133_owned_records": f"""WITH {_M}, r AS (SELECT bin, contig FROM members WHERE bin LIKE 'g%'), o AS (SELECT contig, CASE WHEN contig % 10 = 0 THEN 'g1' ELSE bin END AS bin FROM r WHERE contig % 5 = 0),
e AS (SELECT r.bin, r.contig FROM r LEFT JOIN o ON o.contig = r.contig WHERE o.bin IS NULL OR o.bin = r.bin UNION ALL SELECT bin, contig FROM o WHERE (bin, contig) NOT IN (SELECT (bin, contig) FROM r)) SELECT bin, contig, count(*) OVER (PARTITION BY contig) AS times FROM e""",
    "q134_unknown_bins": f"WITH {sql('contigs', 'originals')}, {_MEMBERS} SELECT DISTINCT bin FROM members WHERE bin NOT IN (SELECT regexp_replace(bin, '^b', 'g') FROM originals WHERE bin <> 'b3')",
    "q135_refreshed": f"WITH {sql('bins')}, n AS (SELECT rank, bin, completeness FROM bins WHERE region = 1 OR contigs % 6 = 0) SELECT rank, bin, completeness, CAST(NULL AS INTEGER) AS contigs FROM n UNION ALL SELECT rank, bin, NULL, contigs FROM bins WHERE rank NOT IN (SELECT rank FROM n)",
    "q136_annotation_plan": f"""WITH {sql("contigs", "bins")}, {_MEMBERS}, w AS (SELECT bin, domain, CASE WHEN bin IN ('g2','g5') THEN CASE WHEN contig % 11 = 0 THEN 'Mycoplasma bovis' WHEN contig % 13 = 0 THEN 'spiro-plasma' ELSE genus END WHEN bin = 'g7' THEN 'Mycoplasma' ELSE genus END AS name FROM members),
h AS (SELECT *, CASE WHEN domain = 'Bacteria' AND name <> 'Unclassified' THEN CASE WHEN list_has_any(regexp_extract_all(lower(name), '[a-z]+'), ['mycoplasma','spiroplasma']) THEN 4 ELSE 11 END END AS hint FROM w),
g AS (SELECT bin, count(*) AS contigs, count(DISTINCT hint) AS hints, max(hint) AS top, coalesce(string_agg(DISTINCT domain, ',' ORDER BY domain) FILTER (domain <> 'Unclassified'), '') AS domains FROM h GROUP BY 1),
m AS (SELECT replace(bin, 'NATION_', 'g') AS bin, CASE WHEN contigs > 17 THEN 'Bacteria' END AS md, CASE WHEN contigs % 6 = 0 THEN 4 END AS mc FROM bins WHERE contigs % 3 = 0), j AS (SELECT g.*, md, mc, coalesce(md, domains) AS dom, hints = 1 AND top = 4 AS four FROM g LEFT JOIN m ON m.bin = g.bin)
SELECT bin, coalesce(mc, CASE WHEN four THEN 4 ELSE 11 END) AS code, CASE WHEN mc IS NOT NULL THEN 'metadata' WHEN four THEN 'taxon_hint' ELSE 'default' END AS code_source,
  CASE WHEN bin = 'Unclassified' OR starts_with(bin, 'unclassified_') THEN 'catch_all' WHEN dom <> 'Bacteria' THEN 'domains:' || CASE WHEN dom = '' THEN 'unknown' ELSE dom END WHEN hints > 1 AND mc IS NULL THEN 'mixed_codes' END AS reason FROM j""",
    "q137_inspected": """WITH p AS (SELECT translate(p_name || '_' || p_partkey, '_', '-') AS bin, CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) END AS c FROM part), g AS (SELECT bin, c, list_filter(['ring','steel','small'], lambda x: list_contains(regexp_extract_all(lower(bin), '[a-z]+'), x)) AS met FROM p)
SELECT bin, CASE WHEN len(met) = 1 THEN met[1] END AS group FROM g WHERE lower(bin) <> 'unclassified' AND (len(met) = 1 OR coalesce(c >= 30, false))""".replace("AS group", 'AS "group"'),
    "q138_namespaced": """WITH k AS (SELECT 'k' || doc_id % 300 AS name, sha256(text) AS seq FROM documents WHERE doc_id < 300), o AS (SELECT 'k' || doc_id % 400 AS name, sha256(text) AS seq, source FROM documents)
SELECT name, seq FROM k UNION SELECT CASE WHEN k.seq IS NOT NULL AND k.seq <> o.seq THEN 'intermediate_' || substring(sha256(source), 1, 12) || '_' || o.name ELSE o.name END, o.seq FROM o LEFT JOIN k ON k.name = o.name""",
    "q139_first_seen": """WITH l AS (SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, CAST(floor(l_extendedprice) AS BIGINT) AS price FROM lineitem) SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber, l_partkey, price) = 1""",
    "q140_offsets": """WITH o AS (SELECT o_custkey AS genome, o_orderkey AS marker, CAST(floor(o_totalprice / 1000) AS BIGINT) AS length FROM orders), s AS (SELECT genome, marker, length, CAST(sum(length) OVER (PARTITION BY genome ORDER BY marker ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e FROM o) SELECT genome, marker, e - length + 1 AS start, e AS "end" FROM s""",
    "q141_widest_gap": f"WITH {sql('orfs')}, g AS (SELECT contig, strand, lead(orf) OVER (PARTITION BY contig, strand ORDER BY orf) - orf - 1 AS gap FROM orfs) SELECT contig, strand, coalesce(max(gap), 0) AS max_gap, count(*) AS genes FROM g GROUP BY 1, 2",
    "q142_lineage_weights": f"""WITH RECURSIVE {taxa._CLOSURE}, {taxa._HEIGHT}, c AS (SELECT concat('b', c_custkey % 50) AS bin, CAST(floor(abs(c_acctbal)) AS BIGINT) + 1 AS length, CASE WHEN c_nationkey % 6 <> 0 THEN c_nationkey % 3 + 2000 END AS taxid FROM customer), t AS (SELECT bin, sum(length) AS named FROM c WHERE taxid IS NOT NULL GROUP BY 1),
s AS (SELECT bin, ancestor, sum(length) AS bp FROM c JOIN tree ON node = taxid GROUP BY ALL)
SELECT bin, ancestor AS taxid, round(CAST(bp AS DOUBLE) / named, 6) AS support FROM s JOIN t USING (bin) JOIN h USING (ancestor) WHERE bp >= 0.7 * named QUALIFY row_number() OVER (PARTITION BY bin ORDER BY depth DESC, ancestor) = 1""",
    "q143_annotation_counts": f"""WITH {sql("features")} SELECT contig, count(*) FILTER (kind = 'cds') AS cds, count(*) FILTER (kind = 'tRNA') AS trna, count(*) FILTER (kind = 'rRNA') AS rrna, count(*) FILTER (kind = 'crispr') AS crispr,
  count(*) FILTER (kind = 'cds' AND contains(lower(product), 'hypothetical')) AS hypothetical, count(*) FILTER (kind = 'cds' AND NOT contains(lower(product), 'hypothetical')) AS named, count(*) AS features FROM features GROUP BY 1""",
    "q144_feature_filter": f"""WITH {sql("features")} SELECT locus, 'MH' || upper(substring(sha256(contig || chr(9) || locus), 1, 12)) AS tag, CASE locus % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false END AS partial FROM features WHERE kind = 'cds' AND contains(lower(product), 'kinase')""",
    "q145_bin_order": f"""WITH {sql("bins")}, p AS (SELECT *, CASE rank WHEN 'order' THEN 4 WHEN 'family' THEN 5 WHEN 'genus' THEN 6 WHEN 'species' THEN 7 ELSE 99 END AS place FROM bins) SELECT rank, bin, row_number() OVER (ORDER BY place, contains(lower(bin), 'unclassified'), bp DESC, bin) AS row, place FROM p""",
    "q146_dashboard_filter": f"""WITH {sql("bins")} SELECT bin, rank, coalesce(completeness >= 70 AND contamination <= 10, false) AS passed, CASE WHEN bp > 0 THEN round(contigs * 1e6 / bp, 4) ELSE 0 END AS per_mbp FROM bins WHERE rank IN ('genus','order') AND bp > 0""",
    "q147_changes": None,
    "q148_bin_metrics": f"""WITH {_M}, p AS (SELECT bin, count(*) AS contigs, CAST(sum(length) AS BIGINT) AS bp, round(sum(length * gc) / sum(length) * 100, 4) AS gc, round(sum(length * coalesce(depth, 0)) / sum(length), 4) AS coverage FROM members GROUP BY 1),
r AS (SELECT bin, length, row_number() OVER w AS k, sum(length) OVER w AS run, sum(length) OVER (PARTITION BY bin) AS total FROM members WINDOW w AS (PARTITION BY bin ORDER BY length DESC, contig ROWS UNBOUNDED PRECEDING)),
n AS (SELECT bin, max(CASE WHEN 2 * run >= total THEN length END) AS n50, min(CASE WHEN 2 * run >= total THEN k END) AS l50 FROM r GROUP BY 1) SELECT bin, contigs, bp, gc, coverage, n50, l50, CASE WHEN bp > 0 THEN round(contigs * 1e6 / bp, 4) ELSE 0 END AS per_mbp FROM p JOIN n USING (bin)""",
    "q149_sample_ranks": f"""WITH {_ORIG}, p AS (SELECT contig % 4 AS sample, rank, bin, count(*) AS contigs, sum(length) AS bp FROM named GROUP BY ALL)
SELECT sample, rank, count(*) AS bins, CAST(median(bp) AS DOUBLE) AS median_bp, CAST(median(contigs) AS DOUBLE) AS median_contigs, arg_min(bin, (-contigs, bin)) AS most_fragmented FROM p GROUP BY 1, 2""",
    "q150_sample_matrix": f"WITH {_ORIG} SELECT rank || '::' || bin AS bin, " + ", ".join(f"CAST(coalesce(sum(length) FILTER (domain = '{x}'), 0) AS BIGINT) AS {x}" for x in ("Archaea", "Bacteria", "Eukaryota")) + " FROM named GROUP BY 1",
    "q151_complete_depth": f"""WITH {_M}, p AS (SELECT bin, domain, CASE WHEN count(*) = count(depth) THEN round(sum(length * depth) / sum(length), 4) END AS depth, sum(length) AS bp FROM members GROUP BY ALL) SELECT bin, domain, depth, CAST(median(bp) OVER (PARTITION BY domain) AS DOUBLE) AS group_median FROM p""",
    "q152_unused_candidates": f"WITH {_M} SELECT contig, genus FROM contigs WHERE genus IN ('g1','g4','g8') AND kingdom = 'Unclassified' AND contig % 3 = 0",
    "q153_mate_files": """WITH p AS (SELECT concat('s', conv_id) AS sample, count(*) FILTER (role = 'user') AS a, count(*) FILTER (role <> 'user') AS b FROM conversations GROUP BY 1) SELECT sample, CASE WHEN a = 1 AND b = 1 THEN 'paired' WHEN a > 1 OR b > 1 THEN 'ambiguous' ELSE 'incomplete' END AS status FROM p""",
    "q154_scatter": f"""WITH {sql("contigs")}, c AS (SELECT * FROM contigs WHERE length >= 2000 AND (depth IS NOT NULL OR contig % 3 = 0)) SELECT contig, length, (SELECT count(*) FROM c) > 500 AS trimmed FROM c ORDER BY length DESC, contig LIMIT 500""",
    "q155_record_counts": "SELECT source, count(*) AS records, count(*) FILTER (contains(text, 'circular=true') OR contains(text, 'the ')) AS marked FROM documents GROUP BY 1",
}


def _changes_sql():
    from . import reads

    both = lambda b, a, n: f"CASE WHEN {b} IS NULL OR {a} IS NULL THEN 'NA' ELSE printf('%.{n}f', {b}) || ' -> ' || printf('%.{n}f', {a}) || ' (' || printf('%+.{n}f', {a} - {b}) || ')' END"
    return f"""WITH {sql("originals", "bins")}, b AS (SELECT bin, sum(length) AS b_bp FROM originals GROUP BY 1), a AS (SELECT bin, sum(length + CASE WHEN contig % 2 = 0 THEN length ELSE 0 END) AS a_bp FROM originals WHERE contig % 5 <> 0 GROUP BY 1), {reads._QA}
SELECT bin, {both("bc", "ac", 1)} AS completeness, {both("bx", "ax", 2)} AS contamination, printf('%.3f', CAST(a_bp AS DOUBLE) / b_bp) AS ratio FROM b JOIN a USING (bin) JOIN qa USING (bin)"""


SQL["q147_changes"] = _changes_sql()
QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q1")}
