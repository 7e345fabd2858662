"""Queries on read alignments: filters, routing, depth, retention, junctions, competition and adoption, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mapping
from .shapes import shape, sql


def _bins(spark, d):
    return shape(spark, d, "originals").where("domain <> 'Unclassified'").select("contig", "bin")


def q80_depth_breadth(spark, d):
    return mapping.depth_breadth(shape(spark, d, "alignments"), shape(spark, d, "originals").select("contig", "length"))


def q81_route_pairs(spark, d):
    return mapping.route_pairs(shape(spark, d, "alignments"), _bins(spark, d), strict=False)


def q81b_route_singles(spark, d):
    return mapping.route_singles(shape(spark, d, "alignments"), _bins(spark, d), strict=False).groupBy("routing").agg(F.count("*").cast("long").alias("n"))


def q82_pools(spark, d):
    rows = shape(spark, d, "alignments")
    return mapping.pools(mapping.route_pairs(rows, _bins(spark, d), strict=False), rows)


def q83_retention(spark, d):
    return mapping.retention(shape(spark, d, "paf"), shape(spark, d, "originals"), "bin")


def _before_after(spark, d):
    """Bins before and after: the original contigs, and those that the alignments to them keep."""
    o = shape(spark, d, "originals")
    before = o.groupBy("bin").agg(F.sum("length").alias("b_bp"), F.count("*").alias("b_contigs"), F.max("length").alias("b_n50"))
    after = o.where("contig % 5 <> 0").groupBy("bin").agg(F.sum(F.col("length") + F.when(F.col("contig") % 2 == 0, F.col("length")).otherwise(0)).alias("a_bp"), F.count("*").alias("a_contigs"), F.max("length").alias("a_n50"))
    qa = shape(spark, d, "bins").select(F.regexp_replace("bin", "NATION_", "b").alias("bin"), F.col("completeness").alias("b_completeness"), F.col("contamination").alias("b_contamination"), F.col("rank").alias("b_lineage"), (F.col("completeness") + F.col("region") - 1).alias("a_completeness"), (F.col("contamination") + F.col("region") * 0.5).alias("a_contamination"), F.when(F.col("region") != 2, F.col("rank")).otherwise("NA").alias("a_lineage"))
    return before.join(after, "bin").join(qa, "bin").withColumn("retained", F.lit(0.96))


def q84_acceptance(spark, d):
    rows = _before_after(spark, d)
    outcome, state = mapping.acceptance_with_markers()
    return rows.select("bin", mapping.acceptance(rows).alias("plain"), outcome.alias("outcome"), state.alias("marker_state"))


def q85_junction_reads(spark, d):
    rows = shape(spark, d, "alignments").withColumn("boundary", F.col("pos") + 30)
    return mapping.spans_junction(rows).groupBy("spans", "anchored").agg(F.count("*").cast("long").alias("n"))


def q86_junction_support(spark, d):
    junctions = shape(spark, d, "originals").select(F.col("contig").alias("rname"), (F.col("length") % 2000 + 30).alias("boundary"))
    return mapping.junction_support(shape(spark, d, "alignments"), junctions)


def q87_junction_sequences(spark, d):
    from .networks import _sequences

    seqs = _sequences(spark, d).withColumn("cut", F.col("id") % 40)
    return mapping.junction_sequences(seqs, "cut").select("id", F.sha2("junction", 256).alias("sha"), "coordinate", "core_length")


def q88_competitive(spark, d):
    return mapping.competitive(shape(spark, d, "alignments"), _bins(spark, d))


def q88b_competitive_ties(spark, d):
    return mapping.competitive(shape(spark, d, "alignments"), _bins(spark, d), ties=True)


def q89_recruited(spark, d):
    return mapping.recruited(shape(spark, d, "alignments"), 0.9, 0.97)


def q89b_templates(spark, d):
    rows = shape(spark, d, "alignments")
    return mapping.templates(rows, mapping.recruited(rows, 0.9, 0.99)).groupBy("qname", "mate").agg(F.count("*").cast("long").alias("records"))


def _links(spark, d):
    o = shape(spark, d, "originals")
    rows = shape(spark, d, "alignments").withColumn("bin", F.concat(F.lit("b"), F.col("qname") % 25))
    return mapping.link_candidates(rows, o.select("contig", "length"), o.select("bin", "contig"), 5, 0.1)


def q90_link_candidates(spark, d):
    return _links(spark, d)


def q91_adopted(spark, d):
    return mapping.adopted(_links(spark, d), _bins(spark, d).where("contig % 2 = 0"))


def q92_growth(spark, d):
    o = shape(spark, d, "orfs")
    rounds = o.groupBy(F.col("contig").alias("bin"), (F.col("orf") % 5).alias("round")).agg(F.count("*").alias("new")).select("bin", "round", "new", F.lit(4).alias("seed"), F.lit(24).alias("whole"))
    return mapping.growth(rounds, 1.0, 0.75, 2, 0.2).select("bin", "round", "new", "held", "growth", "outcome")


_OPS = "SELECT {k}, generate_subscripts(regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]'), 1) AS i, unnest(regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]')) AS x FROM {t}"
_SUM = "list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[{k}]', 1), lambda x: CAST(x AS BIGINT)))"
_BINS = "binned AS (SELECT contig, bin FROM originals WHERE domain <> 'Unclassified')"
_ROUTE = f"""{sql("alignments", "originals")}, {_BINS}, p AS (SELECT a.*, coalesce(bin, '') AS b, flag & 4 = 0 AND mapq >= 10 AS good FROM alignments a LEFT JOIN binned ON rname = contig WHERE flag & 2304 = 0)"""
_PAIRS = f"""{_ROUTE}, g AS (SELECT qname, count(*) AS n, count(*) FILTER (good) AS ok, count(*) FILTER (flag & 64 <> 0) AS f, count(*) FILTER (flag & 128 <> 0) AS s, max(CASE WHEN good AND flag & 64 <> 0 THEN b END) AS x, max(CASE WHEN good AND flag & 128 <> 0 THEN b END) AS y FROM p GROUP BY 1),
r AS (SELECT qname, x, CASE WHEN n <> 2 THEN 'invalid_pair' WHEN ok <> 2 THEN 'unmapped_or_ambiguous' WHEN f <> 1 OR s <> 1 THEN 'invalid_pair' WHEN x = '' OR x <> y THEN 'cross_bin' ELSE 'accepted' END AS routing FROM g)"""
_UNION = "SELECT {g}, CAST(sum(greatest(0, hi - greatest(lo, coalesce(top, lo)))) AS BIGINT) AS u FROM (SELECT *, max(hi) OVER (PARTITION BY {g} ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM (SELECT DISTINCT {g}, lo, hi FROM {t})) GROUP BY {g}"
_BLOCKS = """ops AS (SELECT rid, i, CAST(regexp_extract(x, '[0-9]+') AS INT) AS n, right(x, 1) AS op FROM (SELECT rid, generate_subscripts(l, 1) AS i, unnest(l) AS x FROM (SELECT rid, regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]') AS l FROM a))),
run AS (SELECT *, coalesce(sum(CASE WHEN op IN ('M','=','X','D','N') THEN n END) OVER w, 0) AS r, coalesce(sum(CASE WHEN op IN ('M','=','X','I','S') THEN n END) OVER w, 0) AS q FROM ops WINDOW w AS (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
hit AS (SELECT a.rid, arg_min(CAST(q + boundary - (r + pos - 1) - 25 AS BIGINT), i) AS s FROM run JOIN a USING (rid) WHERE op IN ('M','=','X') AND r + pos - 1 <= boundary - 25 AND r + n + pos - 1 >= boundary + 25 GROUP BY 1),
judged AS (SELECT a.*, s IS NOT NULL AS spans, coalesce(length(substring(qual, s + 1, 50)) = 50 AND NOT regexp_matches(substring(qual, s + 1, 50), '[!-4]'), false) AS anchored FROM a LEFT JOIN hit USING (rid))"""
_QA = """qa AS (SELECT replace(bin, 'NATION_', 'b') AS bin, completeness AS bc, contamination AS bx, rank AS bl, completeness + region - 1 AS ac, contamination + region * 0.5 AS ax, CASE WHEN region <> 2 THEN rank ELSE 'NA' END AS al FROM bins)"""
_LINKS = f"""{sql("alignments", "originals")}, g AS (SELECT concat('b', qname % 25) AS bin, rname AS contig, qname, pos - 1 AS lo, pos - 1 + {_SUM.format(k='MDN=X')} AS hi FROM alignments WHERE flag & 2308 = 0),
f AS (SELECT g.*, o.length FROM g JOIN originals o ON g.contig = o.contig WHERE o.bin <> g.bin), n AS (SELECT bin, contig, length, count(DISTINCT qname) AS reads FROM f GROUP BY ALL),
iv AS (SELECT bin, contig, greatest(lo, 0) AS lo, least(hi, length) AS hi FROM f WHERE least(hi, length) > greatest(lo, 0)), u AS ({_UNION.format(g='bin, contig', t='iv')}),
links AS (SELECT bin, contig, reads, round(CAST(u AS DOUBLE) / length, 6) AS share FROM n JOIN u USING (bin, contig) WHERE reads >= 5 AND round(CAST(u AS DOUBLE) / length, 6) >= 0.1)"""
_COMP = f"""{sql("alignments", "originals")}, {_BINS}, m AS (SELECT qname, bin, CASE WHEN flag & 64 <> 0 THEN 1 WHEN flag & 128 <> 0 THEN 2 ELSE 0 END AS mate, max(score) AS best FROM alignments JOIN binned ON rname = contig WHERE flag & 4 = 0 GROUP BY ALL),
t AS (SELECT qname, bin, CAST(sum(best) AS BIGINT) AS total FROM m GROUP BY ALL), h AS (SELECT *, max(total) OVER (PARTITION BY qname) AS top FROM t)"""

SQL = {
    "q80_depth_breadth": f"""WITH {sql("alignments", "originals")}, g AS (SELECT rname, {_SUM.format(k="M=X")} AS bases, pos - 1 AS lo, pos - 1 + {_SUM.format(k="MDN=X")} AS hi FROM alignments WHERE flag & 2308 = 0 AND mapq >= 10),
s AS (SELECT rname, sum(bases) AS bases FROM g GROUP BY 1), iv AS (SELECT contig, greatest(lo, 0) AS lo, least(hi, length) AS hi FROM g JOIN originals ON rname = contig WHERE least(hi, length) > greatest(lo, 0)), u AS ({_UNION.format(g="contig", t="iv")})
SELECT o.contig, round(CAST(coalesce(bases, 0) AS DOUBLE) / length, 6) AS mean_depth, round(CAST(coalesce(u, 0) AS DOUBLE) / length, 6) AS covered_fraction FROM originals o LEFT JOIN s ON rname = o.contig LEFT JOIN u ON u.contig = o.contig""",
    "q81_route_pairs": f"WITH {_PAIRS} SELECT qname, routing, CASE WHEN routing = 'accepted' THEN x END AS bin FROM r",
    "q81b_route_singles": f"WITH {_ROUTE}, g AS (SELECT count(*) AS n, max(good) AS good, max(CASE WHEN good THEN b END) AS x FROM p GROUP BY qname) SELECT CASE WHEN n <> 1 THEN 'invalid_read' WHEN NOT good THEN 'unmapped_or_ambiguous' WHEN x = '' THEN 'unassigned' ELSE 'accepted' END AS routing, count(*) AS n FROM g GROUP BY 1",
    "q82_pools": f"WITH {_PAIRS} SELECT x AS bin, CASE WHEN flag & 64 <> 0 THEN 'R1' WHEN flag & 128 <> 0 THEN 'R2' ELSE 'SE' END AS mate, count(*) AS records, CAST(sum({_SUM.format(k='MIS=X')}) AS BIGINT) AS bases FROM p JOIN r USING (qname) WHERE routing = 'accepted' GROUP BY 1, 2",
    "q83_retention": f"""WITH {sql("paf", "originals")}, g AS (SELECT p.bin, qname, greatest(lo, 0) AS lo, least(hi, length) AS hi FROM paf p JOIN originals o ON qname = contig WHERE alen > 0 AND nmatch >= 0.95 * alen AND least(hi, length) > greatest(lo, 0)), u AS ({_UNION.format(g="bin, qname", t="g")})
SELECT bin, CAST(sum(u) AS BIGINT) AS aligned, round(CAST(sum(u) AS DOUBLE) / (SELECT sum(length) FROM originals), 6) AS retained FROM u GROUP BY bin""",
    "q84_acceptance": f"""WITH {sql("originals", "bins")}, b AS (SELECT bin, sum(length) AS b_bp, count(*) AS b_contigs, max(length) AS b_n50 FROM originals GROUP BY 1),
a AS (SELECT bin, sum(length + CASE WHEN contig % 2 = 0 THEN length ELSE 0 END) AS a_bp, count(*) AS a_contigs, max(length) AS a_n50 FROM originals WHERE contig % 5 <> 0 GROUP BY 1), {_QA},
j AS (SELECT *, CAST(a_bp AS DOUBLE) / greatest(b_bp, 1) AS ratio, a_contigs <= b_contigs * 0.9 OR a_n50 >= greatest(b_n50, 1) * 1.2 AS less, bc IS NOT NULL AND ac IS NOT NULL AND bx IS NOT NULL AND ax IS NOT NULL AND bl NOT IN ('', 'NA') AND bl = al AS same FROM b JOIN a USING (bin) JOIN qa USING (bin)),
o AS (SELECT *, CASE WHEN ratio < 0.95 THEN 'rejected_sequence_loss' WHEN ratio > 1.25 THEN 'rejected_length_inflation' END AS early FROM j)
SELECT bin, coalesce(early, CASE WHEN less THEN 'accepted' ELSE 'rejected_no_gain' END) AS plain,
  coalesce(early, CASE WHEN same AND ac < bc - 1 THEN 'rejected_completeness_loss' WHEN same AND ax > bx + 1 THEN 'rejected_contamination_gain' WHEN less OR (same AND ac >= bc + 2) THEN 'accepted' ELSE 'rejected_no_gain' END) AS outcome,
  CASE WHEN early IS NOT NULL THEN 'not_evaluated' WHEN same THEN 'compared' ELSE 'unavailable_or_different_lineage' END AS marker_state FROM o""",
    "q85_junction_reads": f"WITH {sql('alignments')}, a AS (SELECT *, pos + 30 AS boundary, row_number() OVER () AS rid FROM alignments), {_BLOCKS} SELECT spans, anchored, count(*) AS n FROM judged GROUP BY ALL",
    "q86_junction_support": f"""WITH {sql("alignments", "originals")}, j AS (SELECT contig AS rname, length % 2000 + 30 AS boundary FROM originals),
a AS (SELECT x.*, boundary, row_number() OVER () AS rid FROM alignments x JOIN j USING (rname) WHERE flag & 3844 = 0 AND mapq >= 20 AND nm <= 0.02 * {_SUM.format(k="MI=X")}), {_BLOCKS},
s AS (SELECT rname, count(DISTINCT CASE WHEN spans AND anchored THEN qname END) AS reads, count(DISTINCT CASE WHEN spans AND anchored THEN concat(pos, ' ', flag & 16) END) AS starts,
  count(DISTINCT CASE WHEN flag & 2 <> 0 AND flag & 8 = 0 AND tlen BETWEEN 1 AND 1000 AND pos - 1 < boundary - 25 AND pnext - 1 >= boundary + 25 THEN qname END) AS pairs FROM judged GROUP BY 1)
SELECT rname, coalesce(reads, 0) AS reads, coalesce(starts, 0) AS starts, coalesce(pairs, 0) AS pairs, CASE WHEN reads >= 5 AND starts >= 3 THEN 'junction_read_supported' WHEN reads > 0 OR pairs > 0 THEN 'limited_junction_support' ELSE 'no_unique_junction_support' END AS status FROM j LEFT JOIN s USING (rname)""",
    "q87_junction_sequences": None,
    "q88_competitive": f"WITH {_COMP} SELECT qname, min(bin) AS bin, min(total) AS total FROM h WHERE total = top GROUP BY qname HAVING count(*) = 1",
    "q88b_competitive_ties": f"WITH {_COMP} SELECT qname, bin, total FROM h WHERE total = top",
    "q89_recruited": f"WITH {sql('alignments')} SELECT DISTINCT qname FROM alignments WHERE flag & 4 = 0 AND {_SUM.format(k='M=X')} >= 0.9 * {_SUM.format(k='MIS=X')} AND nm <= 0.03 * {_SUM.format(k='M=X')}",
    "q89b_templates": f"""WITH {sql('alignments')}, n AS (SELECT DISTINCT qname FROM alignments WHERE flag & 4 = 0 AND {_SUM.format(k='M=X')} >= 0.9 * {_SUM.format(k='MIS=X')} AND nm <= 0.01 * {_SUM.format(k='M=X')})
SELECT qname, CASE WHEN flag & 64 <> 0 THEN 'R1' WHEN flag & 128 <> 0 THEN 'R2' ELSE 'single' END AS mate, count(*) AS records FROM alignments JOIN n USING (qname) WHERE flag & 2304 = 0 GROUP BY 1, 2""",
    "q90_link_candidates": f"WITH {_LINKS} SELECT * FROM links",
    "q91_adopted": f"""WITH {_LINKS}, {_BINS}, fr AS (SELECT * FROM links WHERE contig NOT IN (SELECT contig FROM binned WHERE contig % 2 = 0)), top AS (SELECT *, rank() OVER (PARTITION BY contig ORDER BY share DESC, reads DESC) AS k FROM fr)
SELECT contig, min(bin) AS bin FROM top WHERE k = 1 GROUP BY contig HAVING count(*) = 1""",
    "q92_growth": f"""WITH {sql("orfs")}, r AS (SELECT contig AS bin, orf % 5 AS round, count(*) AS new FROM orfs GROUP BY ALL), h AS (SELECT *, 4 + coalesce(sum(new) OVER (PARTITION BY bin ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held FROM r),
o AS (SELECT *, CAST(new AS DOUBLE) / greatest(held, 1) AS growth FROM h), c AS (SELECT *, CASE WHEN growth > 1 THEN 'rejected_growth' WHEN (held + new) / 24.0 > 0.75 THEN 'rejected_total_fraction' WHEN new = 0 THEN 'stopped_no_new' WHEN new < 2 OR growth < 0.2 THEN 'stopped_low_gain' ELSE 'accepted' END AS own FROM o),
e AS (SELECT *, coalesce(max(CASE WHEN own <> 'accepted' THEN 1 ELSE 0 END) OVER (PARTITION BY bin ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM c)
SELECT bin, round, new, CAST(held AS BIGINT) AS held, round(growth, 6) AS growth, CASE WHEN ended = 1 THEN 'not_run' ELSE own END AS outcome FROM e""",
}
QUERIES = {name: globals()[name] for name in SQL}


def _late_sql():
    from .networks import _SEQ

    return f"""WITH {_SEQ}, c AS (SELECT id, substring(seq, 1, length(seq) - id % 40) AS core FROM seqs WHERE length(seq) >= 1000), f AS (SELECT *, least(500, length(core) // 3) AS k FROM c)
SELECT id, sha256(right(core, k) || left(core, k)) AS sha, CAST(k AS BIGINT) AS coordinate, CAST(length(core) AS BIGINT) AS core_length FROM f"""


SQL["q87_junction_sequences"] = _late_sql()
