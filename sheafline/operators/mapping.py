"""Read alignments: filters, routing of mates, depth and breadth, retention, junction support, competition between bins.

Alignments have qname, flag, rname, pos (from 1), mapq, cigar and, where named, nm, qual, tlen, pnext and score. Flags are
those of SAM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import intervals

# Bits of the flag field.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, FIRST, SECOND, SECONDARY, BAD, DUPLICATE, SUPPLEMENTARY = 1, 2, 4, 8, 16, 64, 128, 256, 512, 1024, 2048


def none_of(flag: str, bits: int) -> Column:
    return F.col(flag).bitwiseAND(bits) == 0


def primary(rows: DataFrame) -> DataFrame:
    """Neither secondary nor supplementary."""
    return rows.where(none_of("flag", SECONDARY | SUPPLEMENTARY))


def reliable(least: int = 10) -> Column:
    """Mapped, primary and of a mapping quality."""
    return none_of("flag", UNMAPPED | SECONDARY | SUPPLEMENTARY) & (F.col("mapq") >= least)


def cigar_bases(cigar: str, kinds: str) -> Column:
    """Bases of the operations of these kinds."""
    return F.expr(f"aggregate(regexp_extract_all({cigar}, '([0-9]+)[{kinds}]', 1), 0L, (a, x) -> a + bigint(x))")


def depth_breadth(rows: DataFrame, lengths: DataFrame, least: int = 10) -> DataFrame:
    """contig, mean_depth and covered_fraction of all contigs of lengths (contig, length).

    Depth counts aligned bases; breadth is the union of the reference spans, deletions included.
    """
    good = rows.where(reliable(least)).select(F.col("rname").alias("contig"), cigar_bases("cigar", "M=X").alias("bases"), (F.col("pos") - 1).alias("lo"), (F.col("pos") - 1 + cigar_bases("cigar", "MDN=X")).alias("hi"))
    bases = good.groupBy("contig").agg(F.sum("bases").alias("bases"))
    inside = good.join(lengths, "contig").select("contig", F.greatest("lo", F.lit(0)).alias("lo"), F.least("hi", "length").alias("hi")).where("hi > lo")
    covered = intervals.union_length(inside, ["contig"], "lo", "hi").select("contig", "union_bp")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    every = lengths.join(bases, "contig", "left").join(covered, "contig", "left")
    return every.select("contig", F.round(zero("bases") / F.col("length"), 6).alias("mean_depth"), F.round(zero("union_bp") / F.col("length"), 6).alias("covered_fraction"))


def route_pairs(rows: DataFrame, bins: DataFrame, least: int = 10, strict: bool = True) -> DataFrame:
    """qname, routing and bin of read pairs; bins: contig, bin.

    A pair needs exactly two primary records, one of each mate: others are an error, or "invalid_pair" if not strict. Both
    mates must be mapped well and lie in one bin. Mates meet by aggregation; no array of records is built.
    """
    placed = primary(rows).join(bins.withColumnRenamed("contig", "rname"), "rname", "left")
    good = none_of("flag", UNMAPPED) & (F.col("mapq") >= least)
    first, second = ~none_of("flag", FIRST), ~none_of("flag", SECOND)
    at = lambda mate: F.max(F.when(good & mate, F.coalesce(F.col("bin").cast("string"), F.lit(""))))
    n = lambda c: F.sum(c.cast("int"))
    per = placed.groupBy("qname").agg(F.count("*").alias("n"), n(good).alias("good"), n(first).alias("firsts"), n(second).alias("seconds"), at(first).alias("a"), at(second).alias("b"))
    bad = F.lit("invalid_pair") if not strict else F.raise_error(F.concat(F.lit("Expected two primary records of both mates: "), F.col("qname").cast("string"))).cast("string")
    routing = (
        F.when(F.col("n") != 2, bad).when(F.col("good") != 2, "unmapped_or_ambiguous").when((F.col("firsts") != 1) | (F.col("seconds") != 1), bad)
        .when((F.col("a") == "") | (F.col("a") != F.col("b")), "cross_bin").otherwise("accepted")
    )
    return per.select("qname", routing.alias("routing"), F.when(routing == "accepted", F.col("a")).alias("bin"))


def route_singles(rows: DataFrame, bins: DataFrame, least: int = 10, strict: bool = True) -> DataFrame:
    """qname, routing and bin of single reads."""
    placed = primary(rows).join(bins.withColumnRenamed("contig", "rname"), "rname", "left")
    good = none_of("flag", UNMAPPED) & (F.col("mapq") >= least)
    per = placed.groupBy("qname").agg(F.count("*").alias("n"), F.max(good).alias("good"), F.max(F.when(good, F.coalesce(F.col("bin").cast("string"), F.lit("")))).alias("a"))
    bad = F.lit("invalid_read") if not strict else F.raise_error(F.concat(F.lit("More than one primary record: "), F.col("qname").cast("string"))).cast("string")
    routing = F.when(F.col("n") != 1, bad).when(~F.col("good"), "unmapped_or_ambiguous").when(F.col("a") == "", "unassigned").otherwise("accepted")
    return per.select("qname", routing.alias("routing"), F.when(routing == "accepted", F.col("a")).alias("bin"))


def pools(routed: DataFrame, rows: DataFrame) -> DataFrame:
    """Records and bases of each bin's pool, by mate."""
    mate = F.when(~none_of("flag", FIRST), "R1").when(~none_of("flag", SECOND), "R2").otherwise("SE")
    taken = primary(rows).join(routed.where("routing = 'accepted'").select("qname", "bin"), "qname")
    return taken.groupBy("bin", mate.alias("mate")).agg(F.count("*").cast("long").alias("records"), F.sum(cigar_bases("cigar", "MIS=X")).alias("bases"))


def retention(paf: DataFrame, originals: DataFrame, group: str, least: float = 0.95) -> DataFrame:
    """Aligned length over the whole original length for each group; originals: contig, length.

    Alignments of a share of matches count, cut to the contig; contigs without any count in the denominator.
    """
    good = paf.where((F.col("alen") > 0) & (F.col("nmatch") >= F.lit(least) * F.col("alen"))).join(originals.select(F.col("contig").alias("qname"), "length"), "qname")
    cut = good.select(group, "qname", F.greatest("lo", F.lit(0)).alias("lo"), F.least("hi", "length").alias("hi")).where("hi > lo")
    aligned = intervals.union_length(cut, [group, "qname"], "lo", "hi").groupBy(group).agg(F.sum("union_bp").alias("aligned"))
    whole = originals.agg(F.greatest(F.sum("length"), F.lit(1)).alias("whole"))
    return aligned.join(F.broadcast(whole)).select(group, "aligned", F.round(F.col("aligned") / F.col("whole"), 6).alias("retained"))  # one row


def acceptance(rows: DataFrame, least: float = 0.95, most: float = 1.25) -> Column:
    """Outcome of a reassembly from bp, contigs and n50 before and after (b_*, a_*) and retained."""
    ratio = F.col("a_bp") / F.greatest(F.col("b_bp"), F.lit(1))
    lost = (F.col("retained") < least) | (ratio < least)
    return F.when(lost, "rejected_sequence_loss").when(ratio > most, "rejected_length_inflation").when(less_fragmented(), "accepted").otherwise("rejected_no_gain")


def less_fragmented() -> Column:
    return (F.col("a_contigs") <= F.col("b_contigs") * 0.9) | (F.col("a_n50") >= F.greatest(F.col("b_n50"), F.lit(1)) * 1.2)


def acceptance_with_markers(least: float = 0.95, most: float = 1.25) -> tuple[Column, Column]:
    """Outcome and marker_state; completeness, contamination and lineage before and after (b_*, a_*) count where comparable."""
    ratio = F.col("a_bp") / F.greatest(F.col("b_bp"), F.lit(1))
    early = F.when((F.col("retained") < least) | (ratio < least), "rejected_sequence_loss").when(ratio > most, "rejected_length_inflation")
    numbers = ["b_completeness", "a_completeness", "b_contamination", "a_contamination"]
    same = F.coalesce((F.col("b_lineage") == F.col("a_lineage")) & ~F.col("b_lineage").isin("", "NA"), F.lit(False))
    for n in numbers:
        same = same & F.col(n).isNotNull()
    worse = F.when(same & (F.col("a_completeness") < F.col("b_completeness") - 1), "rejected_completeness_loss").when(same & (F.col("a_contamination") > F.col("b_contamination") + 1), "rejected_contamination_gain")
    gain = same & (F.col("a_completeness") >= F.col("b_completeness") + 2)
    outcome = F.coalesce(early, worse, F.when(less_fragmented() | gain, "accepted"), F.lit("rejected_no_gain"))
    return outcome, F.when(early.isNotNull(), "not_evaluated").when(same, "compared").otherwise("unavailable_or_different_lineage")


def _blocks(cigar: str) -> str:
    """SQL: the aligned blocks of a CIGAR string with their start in the reference and in the read, both from 0."""
    step = (
        "(a, x) -> named_struct('r', a.r + if(x.op IN ('M', '=', 'X', 'D', 'N'), x.n, 0), 'q', a.q + if(x.op IN ('M', '=', 'X', 'I', 'S'), x.n, 0), "
        "'out', if(x.op IN ('M', '=', 'X'), concat(a.out, array(named_struct('r', a.r, 'q', a.q, 'n', x.n))), a.out))"
    )
    ops = f"transform(regexp_extract_all({cigar}, '([0-9]+[MIDNSHP=X])', 1), x -> named_struct('n', int(substring(x, 1, length(x) - 1)), 'op', right(x, 1)))"
    return f"aggregate({ops}, named_struct('r', 0, 'q', 0, 'out', cast(array() AS array<struct<r:int,q:int,n:int>>)), {step}, a -> a.out)"


def spans_junction(rows: DataFrame, anchor: int = 25, least: int = 20) -> DataFrame:
    """Adds spans (one aligned block covers the boundary by anchor bases on either side) and anchored (those bases have the quality).

    rows: pos, cigar, qual and boundary (from 0). Qualities are judged in the first block that spans.
    """
    at = f"b.r + pos - 1 <= boundary - {anchor} AND b.r + b.n + pos - 1 >= boundary + {anchor}"
    found = rows.withColumn("_block", F.expr(f"get(filter({_blocks('cigar')}, b -> {at}), 0)"))
    window = F.expr(f"substring(qual, int(_block.q + boundary - (_block.r + pos - 1) - {anchor} + 1), {2 * anchor})")
    poor = "".join(chr(33 + k) for k in range(least))
    fine = (F.length(window) == 2 * anchor) & (F.translate(window, poor, "") == window) & (F.col("qual") != "*")
    return found.withColumn("spans", F.col("_block").isNotNull()).withColumn("anchored", F.coalesce(F.col("spans") & fine, F.lit(False))).drop("_block")


def junction_support(rows: DataFrame, junctions: DataFrame, anchor: int = 25, least_reads: int = 5, least_starts: int = 3) -> DataFrame:
    """rname, spanning reads, distinct starts, bracketing pairs and status; junctions: rname, boundary."""
    placed = rows.where(none_of("flag", UNMAPPED | SECONDARY | BAD | DUPLICATE | SUPPLEMENTARY) & (F.col("mapq") >= 20)).join(junctions, "rname")
    aligned = cigar_bases("cigar", "MI=X")
    close = placed.where((aligned > 0) & (F.col("nm") <= 0.02 * aligned))
    marked = spans_junction(close, anchor)
    pair = ~none_of("flag", PROPER) & none_of("flag", MATE_UNMAPPED) & F.col("tlen").between(1, 1000) & (F.col("pos") - 1 < F.col("boundary") - anchor) & (F.col("pnext") - 1 >= F.col("boundary") + anchor)
    both = F.col("spans") & F.col("anchored")
    per = marked.groupBy("rname").agg(
        F.countDistinct(F.when(both, F.col("qname"))).alias("reads"), F.countDistinct(F.when(both, F.struct("pos", ~none_of("flag", REVERSE)))).alias("starts"), F.countDistinct(F.when(pair, F.col("qname"))).alias("pairs")
    )
    all_ = junctions.select("rname").join(per, "rname", "left").fillna(0, ["reads", "starts", "pairs"])
    status = F.when((F.col("reads") >= least_reads) & (F.col("starts") >= least_starts), "junction_read_supported").when((F.col("reads") > 0) | (F.col("pairs") > 0), "limited_junction_support").otherwise("no_unique_junction_support")
    return all_.withColumn("status", status)


def junction_sequences(seqs: DataFrame, overlap: str, least: int = 1000, flank: int = 500) -> DataFrame:
    """id, junction (the core's end before its start), coordinate and core_length; the terminal overlap is cut off first."""
    core = F.expr(f"substring(seq, 1, length(seq) - {overlap})")
    cut = seqs.where(F.length("seq") >= least).withColumn("_core", core).withColumn("_flank", F.least(F.lit(flank), F.floor(F.length("_core") / 3)).cast("int"))
    return cut.select("id", F.expr("concat(right(_core, _flank), left(_core, _flank))").alias("junction"), F.col("_flank").cast("long").alias("coordinate"), F.length("_core").cast("long").alias("core_length"))


def competitive(rows: DataFrame, bins: DataFrame, ties: bool = False) -> DataFrame:
    """template and bin: each mate's best score in a bin, summed over mates, decides; ties are left out, or all kept."""
    mate = F.when(~none_of("flag", FIRST), 1).when(~none_of("flag", SECOND), 2).otherwise(0)
    placed = rows.where(none_of("flag", UNMAPPED)).join(bins.withColumnRenamed("contig", "rname"), "rname")
    total = placed.groupBy("qname", "bin", mate.alias("mate")).agg(F.max("score").alias("best")).groupBy("qname", "bin").agg(F.sum("best").alias("total"))
    top = total.groupBy("qname").agg(F.max("total").alias("total"))
    held = total.join(top, ["qname", "total"])
    if ties:
        return held.select("qname", "bin", "total")
    return held.groupBy("qname").agg(F.count("*").alias("n"), F.min("bin").alias("bin"), F.min("total").alias("total")).where("n = 1").select("qname", "bin", "total")


def recruited(rows: DataFrame, share: float = 0.8, identity: float = 0.95) -> DataFrame:
    """Distinct names of the reads of which a share is aligned at an identity."""
    aligned, whole = cigar_bases("cigar", "M=X"), cigar_bases("cigar", "MIS=X")
    return rows.where(none_of("flag", UNMAPPED) & (aligned >= share * whole) & (F.col("nm") <= (1 - identity) * aligned)).select("qname").distinct()


def templates(rows: DataFrame, names: DataFrame) -> DataFrame:
    """The records of all mates of the given templates, with mate R1, R2 or single."""
    mate = F.when(~none_of("flag", FIRST), "R1").when(~none_of("flag", SECOND), "R2").otherwise("single")
    return primary(rows).join(names.select("qname").distinct(), "qname", "left_semi").withColumn("mate", mate)


def link_candidates(rows: DataFrame, lengths: DataFrame, own: DataFrame, least_reads: int, least_share: float) -> DataFrame:
    """bin, contig, reads and share of contigs outside a bin that its reads cover well enough.

    rows: bin, and the alignment; lengths: contig, length; own: bin, contig.
    """
    good = rows.where(reliable(0)).select("bin", F.col("rname").alias("contig"), "qname", (F.col("pos") - 1).alias("lo"), (F.col("pos") - 1 + cigar_bases("cigar", "MDN=X")).alias("hi"))
    foreign = good.join(own, ["bin", "contig"], "left_anti").join(lengths, "contig")
    reads = foreign.groupBy("bin", "contig", "length").agg(F.countDistinct("qname").alias("reads"))
    inside = foreign.select("bin", "contig", F.greatest("lo", F.lit(0)).alias("lo"), F.least("hi", "length").alias("hi")).where("hi > lo")
    covered = intervals.union_length(inside, ["bin", "contig"], "lo", "hi").select("bin", "contig", "union_bp")
    both = reads.join(covered, ["bin", "contig"]).withColumn("share", F.round(F.col("union_bp") / F.col("length"), 6))
    return both.where((F.col("reads") >= least_reads) & (F.col("share") >= least_share)).select("bin", "contig", F.col("reads").cast("long").alias("reads"), "share")


def adopted(claims: DataFrame, owned: DataFrame) -> DataFrame:
    """contig and bin: each contig without owner goes to the bin with the strictly best (share, reads)."""
    free = claims.join(owned.select("contig").distinct(), "contig", "left_anti")
    claim = F.struct("share", "reads")
    best = free.groupBy("contig").agg(F.max(claim).alias("top"))
    held = free.join(best, "contig").where(claim == F.col("top"))
    return held.groupBy("contig").agg(F.count("*").alias("n"), F.min("bin").alias("bin")).where("n = 1").select("contig", "bin")


def growth(rounds: DataFrame, most_growth: float, most_share: float, least_new: int, least_growth: float) -> DataFrame:
    """Adds outcome to the rounds of each bin: new reads may grow a set by a bounded ratio and stay under a share of all reads.

    rounds: bin, round, new, seed and whole. After the first round that is not accepted the others are not_run.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("bin").orderBy("round")
    before = F.col("seed") + F.coalesce(F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = rounds.withColumn("held", before).withColumn("growth", F.col("new") / F.greatest(F.col("held"), F.lit(1)))
    share = (F.col("held") + F.col("new")) / F.col("whole")
    own = (
        F.when(F.col("growth") > most_growth, "rejected_growth").when(share > most_share, "rejected_total_fraction").when(F.col("new") == 0, "stopped_no_new")
        .when((F.col("new") < least_new) | (F.col("growth") < least_growth), "stopped_low_gain").otherwise("accepted")
    )
    marked = held.withColumn("_own", own)
    ended = F.coalesce(F.max((F.col("_own") != "accepted").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return marked.withColumn("outcome", F.when(ended == 1, "not_run").otherwise(F.col("_own"))).drop("_own").withColumn("growth", F.round("growth", 6))
