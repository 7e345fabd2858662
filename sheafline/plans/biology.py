"""Queries on pathway evidence, neighbourhoods, sequences, streams and models, with their SQL where there is one."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions import sequences
from ..operators import graph, pathways, select
from ..session import table, written
from .networks import _RC, _SEQ, _sequences
from .shapes import shape, sql

# Event types as components with their scope, and two pathways over them.
COMPONENTS = [("click", "targeted"), ("error", "targeted"), ("purchase", "targeted"), ("signup", "not_assayed"), ("view", "fusion_only")]
MEMBERS = [("p1", "click", 0, True, True), ("p1", "error", 1, True, True), ("p1", "signup", 2, False, True), ("p2", "purchase", 0, True, True), ("p2", "view", 1, False, True), ("p2", "click", 2, True, False)]


def _evidence(spark, d):
    e = table(spark, d, "events")
    status = F.when(F.col("value") > 8, "accepted").otherwise("fragment_candidate")
    hits = e.select(F.col("user_id").alias("bin"), F.col("event_type").alias("component"), F.hour("ts").alias("protein"), status.alias("status"))
    return pathways.component_evidence(hits, spark.createDataFrame(COMPONENTS, "component string, scope string"), e.select(F.col("user_id").alias("bin")).distinct())


def q34_component_evidence(spark, d):
    return _evidence(spark, d)


def q35_pathway_summary(spark, d):
    return pathways.pathway_summary(_evidence(spark, d), spark.createDataFrame(MEMBERS, "pathway string, component string, place int, scored boolean, route boolean"))


def _genes(spark, d):
    from pyspark.sql import Window

    e = table(spark, d, "events").where("event_type <> 'view'")
    minute = (F.unix_timestamp("ts") / 60).cast("long")
    genes = e.select("user_id", minute.alias("s"), (minute + F.col("value").cast("long")).alias("e"), "event_id")
    return genes.withColumn("place", F.row_number().over(Window.partitionBy("user_id").orderBy("s", "e", "event_id")).cast("long") + F.floor(F.col("s") / 5000))


def q36_neighbourhoods(spark, d):
    return pathways.neighbourhoods(_genes(spark, d), "user_id", "place", "s", "e", 0, 600)


def q37_hit_conflicts(spark, d):
    line = table(spark, d, "lineitem")
    span = F.struct((F.col("l_partkey") % 40).alias("lo"), (F.col("l_partkey") % 40 + F.floor("l_quantity").cast("long")).alias("hi"))
    hits = line.select(
        F.col("l_orderkey").alias("protein"), F.format_string("acc%02d-%d-%d-%d", "l_linenumber", "l_partkey", "l_suppkey", F.floor("l_extendedprice").cast("long")).alias("accession"), F.concat(F.lit("t"), F.col("l_suppkey") % 5).alias("target"), F.lit("specific").alias("call_type"),
        F.array(F.concat(F.lit("c"), F.col("l_suppkey") % 3)).alias("components"), (F.floor("l_extendedprice").cast("long") % 1024 / 1024).alias("margin"), (F.floor("l_quantity").cast("long") / 64).alias("coverage"),
        F.array(span).alias("spans"), F.when(F.col("l_returnflag") == "R", "fragment_candidate").otherwise("accepted").alias("status"),
    )
    return pathways.resolve_hits(hits, ["protein"]).select("protein", "accession", "status", "call_type")


def q38_slot_match(spark, d):
    e = table(spark, d, "events")
    genes = e.select("user_id", "ts", "event_id", F.array("event_type").alias("genes"))
    return pathways.slot_fold(genes, "user_id", ["ts", "event_id"], "genes", [["view"], ["click", "signup"], ["purchase"], ["error"]])


def q40_capped_fill(spark, d):
    line = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.col("l_quantity").cast("long").alias("q"))
    return select.capped_fill(line, "l_suppkey", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], "q", 500)


def q42_gc(spark, d):
    s = _sequences(spark, d)
    return s.select("id", sequences.gc_percent(F.col("seq")).alias("gc"), F.round(sequences.gc_weighted(F.col("seq")), 4).alias("gc_eq"))


def q43_kmer_counts(spark, d):
    counted = _sequences(spark, d).select("id", sequences.kmer_counts(4)("seq").alias("c"))
    return counted.select("id", F.posexplode("c").alias("kmer", "n")).where("n > 0").select("id", F.col("kmer").cast("long").alias("kmer"), "n")


def _wrapped(spark, d):
    """Sequences of which a third end as they begin."""
    seq = F.when(F.col("id") % 3 == 0, F.expr("concat(seq, left(seq, int(20 + id % 60)))")).otherwise(F.col("seq"))
    return _sequences(spark, d).select("id", seq.alias("seq"))


def q44_terminal_overlap(spark, d):
    return _wrapped(spark, d).select("id", sequences.terminal_overlap(30, 10_000)("seq").alias("overlap"))


def q160_domain_hits(spark, d):
    return pathways.domain_hits(shape(spark, d, "domains"), shape(spark, d, "models").where("model < 40")).drop("spans", "call_type", "component")


def _domain_hits(spark, d):
    return pathways.domain_hits(shape(spark, d, "domains"), shape(spark, d, "models").where("model < 40"))


def q161_target_states(spark, d):
    bins = shape(spark, d, "domains").select("bin").distinct()
    return pathways.target_states(_domain_hits(spark, d), shape(spark, d, "models").where("model < 40"), bins, {"M7": ("t1", "t2"), "M12": ("t5",)})


def q162_review_hits(spark, d):
    """Hits of each bin: accepted models, distinct accepted proteins, and hits to look at again."""
    good = F.col("status") == "accepted"
    per = _domain_hits(spark, d).groupBy("bin").agg(F.countDistinct(F.when(good, F.col("accession"))).alias("models"), F.countDistinct(F.when(good, F.col("protein"))).alias("proteins"), F.sum((~good | (F.col("call_type") != "specific")).cast("int")).cast("long").alias("review"))
    return per


def q163_hit_rows(spark, d):
    """Accepted hits with their gene's place and their pathways: the row of a report."""
    orfs = shape(spark, d, "orfs").select(F.col("orf").alias("protein"), "contig", "start", "stop")
    paths = spark.createDataFrame(PANEL, "component string, pathway string")
    hits = _domain_hits(spark, d).where("status = 'accepted'").join(orfs, "protein").join(F.broadcast(paths), "component", "left")  # a fixed list
    return hits.groupBy("bin", "protein", "accession", "contig", "start", "stop").agg(F.array_join(F.array_sort(F.collect_set("pathway")), ";").alias("pathways"))


# Components of two pathways, a template of ordered slots.
PANEL = [("k0", "pA"), ("k1", "pA"), ("k2", "pA"), ("k2", "pB"), ("k4", "pB")]
SLOTS = [["click"], ["purchase", "signup"], ["error"], ["view"]]


def _windows(spark, d):
    e = table(spark, d, "events")
    minute = (F.unix_timestamp("ts") / 60).cast("long")
    genes = e.select("user_id", minute.alias("s"), (minute + F.col("value").cast("long")).alias("e"), "event_id", "event_type")
    from pyspark.sql import Window

    genes = genes.withColumn("place", F.row_number().over(Window.partitionBy("user_id").orderBy("s", "e", "event_id")).cast("long"))
    windows = pathways.neighbourhoods(genes, "user_id", "place", "s", "e", 0, 900)
    return pathways.window_genes(windows, genes.select("user_id", "place", F.when(F.col("event_id") % 3 == 0, -1).otherwise(1).alias("strand"), F.array("event_type").alias("components")), "user_id", "place")


def q164_operons(spark, d):
    return pathways.operons(_windows(spark, d), SLOTS, 2, 0.5, 2).select("user_id", "first_place", F.round("score", 6).alias("score"), "orientation", "matched_slots", "observed")


def q164b_window_order(spark, d):
    """Observed order of each window's components with strands, and the widest gap of places."""
    shown = F.array_join(F.transform("genes", lambda g: F.concat(F.array_join(g["components"], ","), F.when(g["strand"] == 1, "(+)").otherwise("(-)"))), " | ")
    return _windows(spark, d).select("user_id", "first_place", "last_place", F.sha2(shown, 256).alias("order_sha"), F.size("genes").cast("long").alias("genes"))


def q165_graph_places(spark, d):
    seqs = written(_sequences(spark, d), "sequences").select(F.concat(F.lit("d"), "id").alias("contig"), "id", "seq")
    segments = seqs.select(F.when(F.col("id") % 5 == 0, F.concat(F.lit("s"), "id")).otherwise(F.col("contig")).alias("segment"), F.length("seq").cast("long").alias("length"), F.when(F.col("id") % 7 == 0, F.reverse("seq")).when(F.col("id") % 11 != 0, F.col("seq")).alias("seq"))
    aliases = seqs.where("id % 13 = 0").select("contig", F.concat(F.lit("s"), "id").alias("alias"))
    paths = seqs.where("id % 17 = 0").select(F.col("contig").alias("path"))
    asked = seqs.select("contig", F.when(F.col("id") % 4 != 1, F.when(F.col("id") % 9 == 0, graph.reverse_complement(F.col("seq"))).otherwise(F.col("seq"))).alias("seq"))
    return graph.resolve_contigs(asked, aliases, paths, segments)


def q166_induced_graph(spark, d):
    from .networks import _links

    links, seeds = _links(spark, d), table(spark, d, "supplier").where("s_nationkey = 7").select((F.col("s_suppkey") + 1_000_000_000).alias("node"))
    return graph.induced(links.distinct(), graph.within_hops(links, seeds, 2).select("node")).groupBy("v").agg(F.count("*").cast("long").alias("n"))


def q167_kmer_frequencies(spark, d):
    shares = _sequences(spark, d).select("id", sequences.kmer_frequencies(2)("seq").alias("f"))
    return shares.select("id", F.posexplode("f").alias("cell", "share")).select("id", F.col("cell").cast("long").alias("cell"), F.round("share", 6).alias("share"))


def q168_kmer_ordination(spark, d):
    """Two principal axes of the sequences' canonical k-mer shares, scaled."""
    # counted once: both fits and the result read the table
    shares = written(_sequences(spark, d).select("id", sequences.kmer_frequencies(4)("seq").alias("f")).where("f IS NOT NULL"), "shares").select("id", array_to_vector("f").alias("v"))
    scaled = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(shares).transform(shares)
    p = vector_to_array("p")
    return PCA(k=2, inputCol="s", outputCol="p").fit(scaled).transform(scaled).select("id", F.round(p[0], 4).alias("pc1"), F.round(p[1], 4).alias("pc2"))


def q56_pca(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    scaled = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(e).transform(e)
    out = PCA(k=2, inputCol="s", outputCol="p").fit(scaled).transform(scaled)
    p = vector_to_array("p")
    return out.select("vec_id", F.round(p[0], 4).alias("pc1"), F.round(p[1], 4).alias("pc2"))


def q57_kmeans(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return KMeans(k=6, seed=7, maxIter=20).fit(e).transform(e).select("vec_id", F.col("prediction").cast("long").alias("cluster"))


def q58_session_windows(spark, d):
    """Sessions of a user's events with gaps under half an hour, the time form of gene neighbourhoods."""
    e = table(spark, d, "events")
    return e.groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count("*").cast("long").alias("n")).groupBy("user_id").agg(F.count("*").cast("long").alias("sessions"), F.max("n").alias("longest"))


_STATE = """bins AS (SELECT DISTINCT user_id AS bin FROM events), comps(component, scope) AS (VALUES ('click','targeted'),('error','targeted'),('purchase','targeted'),('signup','not_assayed'),('view','fusion_only')),
h AS (SELECT user_id AS bin, event_type AS component, count(DISTINCT hour(ts)) FILTER (value > 8) AS good, count(DISTINCT hour(ts)) FILTER (NOT value > 8) AS maybe FROM events GROUP BY ALL),
ev AS (SELECT bins.bin, comps.component, CASE WHEN good > 0 THEN 'detected' WHEN scope = 'not_assayed' THEN 'not_assayed' WHEN scope <> 'targeted' THEN 'fusion_only_not_detected' WHEN maybe > 0 THEN 'candidate_only' ELSE 'not_detected' END AS state,
  CAST(CASE WHEN good > 0 THEN 1 WHEN scope = 'targeted' THEN 0 END AS BIGINT) AS value, CASE WHEN good > 0 OR scope = 'targeted' THEN coalesce(good, 0) END AS copies
  FROM bins CROSS JOIN comps LEFT JOIN h ON h.bin = bins.bin AND h.component = comps.component)"""
_HITS = f"""{sql("domains", "models")}, m AS (SELECT * FROM models WHERE model < 40), dj AS (SELECT d.*, length, seq_cut, dom_cut, target, call, component, context_only, "least" AS lst FROM domains d JOIN m ON m.accession = d.accession WHERE seq_score >= seq_cut AND dom_score >= dom_cut),
dr AS (SELECT *, max(hmm_to) OVER (PARTITION BY bin, protein, accession ORDER BY hmm_from, hmm_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM dj),
dh AS (SELECT bin, protein, accession, target, call, component, context_only, lst, min(ievalue) AS ievalue, count(*) AS domains, any_value(seq_cut) AS sc, any_value(dom_cut) AS dc, arg_max(seq_score, (dom_score, seq_score)) AS bs, max(dom_score) AS bd, sum(greatest(0, hmm_to - greatest(hmm_from - 1, coalesce(top, -1)))) / CAST(any_value(length) AS DOUBLE) AS cov FROM dr GROUP BY ALL),
hits AS (SELECT bin, protein, accession, target, call, component, ievalue, domains, round(least((bs - sc) / CAST(greatest(abs(sc), 1) AS DOUBLE), (bd - dc) / CAST(greatest(abs(dc), 1) AS DOUBLE)), 6) AS margin, round(cov, 6) AS coverage,
  CASE WHEN cov < greatest(0.3, lst) THEN 'fragment_candidate' WHEN context_only THEN 'context_candidate' ELSE 'accepted' END AS status FROM dh)"""
_MEMBERS = ", ".join(f"('{a}', '{b}', {c}, {e}, {f})" for a, b, c, e, f in MEMBERS)

_WINDOWS = """b AS (SELECT user_id, event_type, CAST(floor(epoch(ts) / 60) AS BIGINT) AS s, CAST(floor(epoch(ts) / 60) AS BIGINT) + CAST(trunc(value) AS BIGINT) AS e, event_id FROM events), g AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s, e, event_id) AS place FROM b),
j AS (SELECT a.user_id, a.place AS p, b.place AS q, b.event_type, b.event_id, max(b.e) OVER (PARTITION BY a.user_id, a.place ORDER BY b.place ROWS UNBOUNDED PRECEDING) - a.s + 1 AS span FROM g a JOIN g b ON a.user_id = b.user_id AND b.place >= a.place AND b.s - a.s < 900),
w AS (SELECT user_id, p AS first_place, max(q) AS last_place, count(*) AS genes, string_agg(event_type || CASE WHEN event_id % 3 = 0 THEN '(-)' ELSE '(+)' END, ' | ' ORDER BY q) AS shown,
  list(CASE event_type WHEN 'click' THEN 0 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 1 WHEN 'error' THEN 2 WHEN 'view' THEN 3 ELSE -1 END ORDER BY q) AS slot, list(CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END ORDER BY q) AS strand FROM j WHERE span <= 900 GROUP BY ALL),
f AS (SELECT *, lag(last_place) OVER (PARTITION BY user_id ORDER BY first_place) AS before FROM w), win AS (SELECT * FROM f WHERE genes >= 2 AND (before IS NULL OR before <> last_place))"""
#: Windows in both orientations; longest ordered fillings, gene by gene from the last one on, as lists of 10 * slot + 5 + strand.
_CHAINS = """t AS (SELECT user_id, first_place, 1 AS turn, slot, strand FROM win UNION ALL SELECT user_id, first_place, -1, list_reverse(slot), list_reverse(strand) FROM win),
o AS (SELECT *, len(list_filter(list_distinct(slot), lambda x: x >= 0)) AS observed FROM t),
r AS (SELECT *, len(slot) AS i, CAST([] AS BIGINT[]) AS s0, CAST([] AS BIGINT[]) AS s1, CAST([] AS BIGINT[]) AS s2, CAST([] AS BIGINT[]) AS s3 FROM o WHERE observed >= 2 AND 4 - observed <= 2
  UNION ALL SELECT user_id, first_place, turn, slot, strand, observed, i - 1,
    CASE WHEN slot[i] = 0 AND 1 + len(s1) > greatest(len(s0), len(n1)) THEN list_prepend(10 * slot[i] + 5 + strand[i], s1) WHEN len(n1) > len(s0) THEN n1 ELSE s0 END, n1, n2, n3
  FROM (SELECT *, CASE WHEN slot[i] = 1 AND 1 + len(s2) > greatest(len(s1), len(n2)) THEN list_prepend(10 * slot[i] + 5 + strand[i], s2) WHEN len(n2) > len(s1) THEN n2 ELSE s1 END AS n1
  FROM (SELECT *, CASE WHEN slot[i] = 2 AND 1 + len(s3) > greatest(len(s2), len(n3)) THEN list_prepend(10 * slot[i] + 5 + strand[i], s3) WHEN len(n3) > len(s2) THEN n3 ELSE s2 END AS n2
  FROM (SELECT *, CASE WHEN slot[i] = 3 AND len(s3) = 0 THEN [CAST(10 * slot[i] + 5 + strand[i] AS BIGINT)] ELSE s3 END AS n3 FROM r WHERE i > 0)))),
judged AS (SELECT user_id, first_place, turn AS orientation, turn, CAST(observed AS INT) AS observed, len(s0) AS used, len(s0) / observed AS os, len(list_filter(s0, lambda x: x % 10 - 5 = turn)) / len(s0) AS ss,
  (observed / 4.0E0) * os * ss AS score, array_to_string(list_transform(s0, lambda x: x // 10 + 1), ';') AS matched_slots FROM r WHERE i = 0)"""

SQL = {
    "q34_component_evidence": f"WITH {_STATE} SELECT * FROM ev",
    "q35_pathway_summary": f"""WITH {_STATE}, m(pathway, component, place, scored, route) AS (VALUES {_MEMBERS}),
p AS (SELECT bin, pathway, count(*) FILTER (scored AND coalesce(value, 0) = 1) AS found, count(*) FILTER (scored) AS total, count(*) FILTER (route AND coalesce(value, 0) <> 1) AS off, count(*) FILTER (route AND value IS NULL) AS na,
  coalesce(string_agg(component, ';' ORDER BY place) FILTER (scored AND coalesce(value, 0) = 1), '') AS detected_components, coalesce(string_agg(component, ';' ORDER BY place) FILTER (scored AND coalesce(value, 0) <> 1), '') AS missing_components
  FROM ev JOIN m USING (component) GROUP BY ALL)
SELECT bin, pathway, round(100.0::DOUBLE * found / total, 3) AS panel_percent, CASE WHEN found = total THEN 'complete_target_panel' WHEN found > 0 THEN 'partial_target_panel' ELSE 'not_detected_in_panel' END AS panel_status,
  CASE WHEN off = 0 THEN 'supported_selected_route' WHEN found = 0 THEN 'not_detected_in_panel' WHEN na > 0 THEN 'unresolved_unmeasured_steps' ELSE 'partial_evidence' END AS route_status, detected_components, missing_components FROM p""",
    "q36_neighbourhoods": """WITH b AS (SELECT user_id, CAST(floor(epoch(ts) / 60) AS BIGINT) AS s, CAST(floor(epoch(ts) / 60) AS BIGINT) + CAST(trunc(value) AS BIGINT) AS e, event_id FROM events WHERE event_type <> 'view'),
g AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s, e, event_id) + s // 5000 AS place FROM b),
k AS (SELECT *, CASE WHEN place - lag(place) OVER (PARTITION BY user_id ORDER BY place) - 1 > 0 THEN 1 ELSE 0 END AS nw FROM g),
r AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS run FROM k),
j AS (SELECT a.user_id, a.place AS p, b.place AS q, max(b.e) OVER (PARTITION BY a.user_id, a.place ORDER BY b.place ROWS UNBOUNDED PRECEDING) - a.s + 1 AS span FROM r a JOIN r b ON a.user_id = b.user_id AND a.run = b.run AND b.place >= a.place),
w AS (SELECT user_id, p AS first_place, max(q) AS last_place, count(*) AS genes FROM j WHERE span <= 600 GROUP BY ALL),
f AS (SELECT *, lag(last_place) OVER (PARTITION BY user_id ORDER BY first_place) AS before FROM w)
SELECT user_id, first_place, last_place, genes FROM f WHERE genes >= 2 AND (before IS NULL OR before <> last_place)""",
    "q42_gc": f"""WITH {_SEQ} SELECT id, CASE WHEN length(seq) > 0 THEN round(100.0::DOUBLE * (length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) / length(seq), 2) END AS gc,
round(((length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) * 6 + (length(seq) - length(replace(seq, 'N', ''))) * 3) / 6.0::DOUBLE, 4) AS gc_eq FROM seqs""",
    "q43_kmer_counts": f"""WITH {_SEQ}, p AS (SELECT id, substring(seq, i, 4) AS f FROM (SELECT id, seq, unnest(range(1, length(seq) - 2)) AS i FROM seqs)), g AS (SELECT id, f FROM p WHERE NOT contains(f, 'N')),
b AS (SELECT id, f FROM g UNION ALL SELECT id, reverse(translate(f, 'ACGT', 'TGCA')) FROM g)
SELECT id, CAST(64 * (instr('ACGT', f[1]) - 1) + 16 * (instr('ACGT', f[2]) - 1) + 4 * (instr('ACGT', f[3]) - 1) + instr('ACGT', f[4]) - 1 AS BIGINT) AS kmer, count(*) AS n FROM b GROUP BY ALL""",
    "q167_kmer_frequencies": f"""WITH {_SEQ}, p AS (SELECT id, substring(seq, i, 2) AS f FROM (SELECT id, seq, unnest(range(1, length(seq))) AS i FROM seqs)), g AS (SELECT id, f FROM p WHERE NOT contains(f, 'N')),
b AS (SELECT id, f FROM g UNION ALL SELECT id, reverse(translate(f, 'ACGT', 'TGCA')) FROM g), c AS (SELECT id, f, count(*) AS n FROM b GROUP BY ALL),
k AS (SELECT f, row_number() OVER (ORDER BY f) - 1 AS cell FROM (SELECT a || b AS f FROM (VALUES ('A'),('C'),('G'),('T')) x(a), (VALUES ('A'),('C'),('G'),('T')) y(b)) WHERE f <= reverse(translate(f, 'ACGT', 'TGCA'))),
t AS (SELECT id, sum(n) AS total FROM c JOIN k USING (f) GROUP BY 1) SELECT t.id, k.cell, round(coalesce(CAST(n AS DOUBLE) / total, 0), 6) AS share FROM t CROSS JOIN k LEFT JOIN c ON c.id = t.id AND c.f = k.f""",
    "q37_hit_conflicts": """WITH RECURSIVE h AS (SELECT l_orderkey AS protein, printf('acc%02d-%d-%d-%d', l_linenumber, l_partkey, l_suppkey, CAST(floor(l_extendedprice) AS BIGINT)) AS accession, l_suppkey % 5 AS target, l_suppkey % 3 AS comp, CAST(floor(l_extendedprice) AS BIGINT) % 1024 / 1024.0::DOUBLE AS margin,
  CAST(floor(l_quantity) AS BIGINT) / 64.0::DOUBLE AS coverage, l_partkey % 40 AS lo, l_partkey % 40 + CAST(floor(l_quantity) AS BIGINT) AS hi, CASE WHEN l_returnflag = 'R' THEN 'fragment_candidate' ELSE 'accepted' END AS status FROM lineitem),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY protein, status = 'accepted' ORDER BY margin DESC, coverage DESC, accession) AS INTEGER) AS place FROM h),
p AS (SELECT a.protein, a.place, b.place AS pl, a.comp <> b.comp AS rival, b.margin - a.margin <= 0.1 AS near, abs(b.margin - a.margin) <= 0.1 AS kin FROM r a JOIN r b ON a.protein = b.protein AND b.place < a.place AND a.target <> b.target WHERE a.status = 'accepted' AND b.status = 'accepted'
  AND greatest(0, least(a.hi, b.hi) - greatest(a.lo, b.lo) + 1) >= 0.5 * least(a.hi - a.lo + 1, b.hi - b.lo + 1)),
s AS (SELECT protein, place, row_number() OVER (PARTITION BY protein ORDER BY place) AS k, list(pl ORDER BY pl) FILTER (rival) AS rivals, list(pl ORDER BY pl) FILTER (rival AND near) AS close, list(pl ORDER BY pl) FILTER (NOT rival AND kin) AS shares FROM p GROUP BY protein, place),
st AS (SELECT DISTINCT protein, CAST(0 AS BIGINT) AS k, CAST([] AS INTEGER[]) AS gone, CAST([] AS INTEGER[]) AS unsure, CAST([] AS INTEGER[]) AS family FROM s
  UNION ALL SELECT protein, k, CASE WHEN len(live) > 0 AND len(nr) = 0 THEN list_append(gone, place) ELSE gone END, CASE WHEN len(nr) > 0 THEN list_concat(list_append(unsure, place), nr) ELSE unsure END, CASE WHEN len(fr) > 0 THEN list_concat(family, [place, fr[1]]) ELSE family END
  FROM (SELECT st.protein, s.k, s.place, gone, unsure, family, list_filter(coalesce(rivals, []), lambda x: NOT list_contains(gone, x)) AS live, list_filter(coalesce(close, []), lambda x: NOT list_contains(gone, x)) AS nr,
    list_filter(coalesce(shares, []), lambda x: NOT list_contains(gone, x) AND NOT list_contains(family, x)) AS fr FROM st JOIN s ON s.protein = st.protein AND s.k = st.k + 1)),
f AS (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY protein ORDER BY k DESC) = 1)
SELECT r.protein, accession, CASE WHEN status = 'accepted' AND list_contains(gone, place) THEN 'competing_hit' WHEN status = 'accepted' AND list_contains(unsure, place) THEN 'ambiguous' ELSE status END AS status,
  CASE WHEN status = 'accepted' AND list_contains(family, place) THEN 'shared_family' ELSE 'specific' END AS call_type FROM r LEFT JOIN f ON f.protein = r.protein""",
    "q38_slot_match": """WITH RECURSIVE g AS (SELECT user_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS b FROM events),
o AS (SELECT user_id, s, a AS k, 1 AS dir FROM g UNION ALL SELECT user_id, s, b, 2 FROM g),
st AS (SELECT DISTINCT user_id, dir, CAST(0 AS BIGINT) AS k, 0 AS v1, 0 AS v2, 0 AS v3, 0 AS v4 FROM o
  UNION ALL SELECT user_id, dir, k, n1, greatest(n1, n2), greatest(n1, n2, n3), greatest(n1, n2, n3, n4) FROM (SELECT st.user_id, st.dir, o.k, greatest(v1, CASE WHEN s = 1 THEN 1 ELSE 0 END) AS n1, greatest(v2, CASE WHEN s = 2 THEN v1 + 1 ELSE 0 END) AS n2, greatest(v3, CASE WHEN s = 3 THEN v2 + 1 ELSE 0 END) AS n3, greatest(v4, CASE WHEN s = 4 THEN v3 + 1 ELSE 0 END) AS n4
    FROM st JOIN o ON o.user_id = st.user_id AND o.dir = st.dir AND o.k = st.k + 1))
SELECT user_id, CAST(max(v4) AS BIGINT) AS slots_matched FROM st GROUP BY 1""",
    "q40_capped_fill": """WITH RECURSIVE l AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(floor(l_quantity) AS BIGINT) AS q, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS k FROM lineitem),
st AS (SELECT DISTINCT l_suppkey, CAST(0 AS BIGINT) AS k, CAST(500 AS BIGINT) AS room, false AS taken FROM l UNION ALL SELECT l.l_suppkey, l.k, CASE WHEN q <= room THEN room - q ELSE room END, q <= room FROM st JOIN l ON l.l_suppkey = st.l_suppkey AND l.k = st.k + 1)
SELECT l.l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, q, taken FROM l JOIN st ON st.l_suppkey = l.l_suppkey AND st.k = l.k""",
    "q44_terminal_overlap": f"""WITH {_SEQ}, w AS (SELECT id, CASE WHEN id % 3 = 0 THEN seq || left(seq, 20 + id % 60) ELSE seq END AS seq FROM seqs),
b AS (SELECT id, seq, list_max(list_filter(range(1, least(10000, length(seq) // 5) + 1), lambda k: left(seq, k) = right(seq, k))) AS n FROM w)
SELECT id, CASE WHEN n >= 30 AND NOT contains(left(seq, n), 'N') THEN n ELSE CAST(0 AS BIGINT) END AS overlap FROM b""",
    "q160_domain_hits": f"""WITH {_HITS} SELECT bin, protein, accession, target, ievalue, domains, margin, coverage, status FROM hits""",
    "q161_target_states": f"""WITH {_HITS}, t AS (SELECT target, min(context_only) AS ctx FROM m GROUP BY 1), b AS (SELECT DISTINCT bin FROM domains),
s AS (SELECT bin, target, max(CASE WHEN status = 'accepted' THEN CASE call WHEN 'specific' THEN 3 WHEN 'shared_family' THEN 2 ELSE 1 END ELSE 0 END) AS k FROM hits GROUP BY ALL),
j AS (SELECT b.bin, t.target, CASE WHEN ctx THEN CASE WHEN k IS NOT NULL THEN 'candidate_only' ELSE 'not_assayed' END WHEN k = 3 THEN 'detected' WHEN k = 2 THEN 'shared_family' WHEN k = 1 THEN 'domain_only' WHEN k = 0 THEN 'candidate_only' ELSE 'not_detected' END AS state
  FROM b CROSS JOIN t LEFT JOIN s ON s.bin = b.bin AND s.target = t.target), g AS (SELECT bin, max(accession = 'M7') AS a, max(accession = 'M12') AS c FROM hits WHERE status = 'accepted' GROUP BY 1)
SELECT j.bin, target, CASE WHEN state = 'not_detected' AND ((coalesce(a, false) AND target IN ('t1','t2')) OR (coalesce(c, false) AND target = 't5')) THEN 'shared_family' ELSE state END AS state FROM j LEFT JOIN g ON g.bin = j.bin""",
    "q162_review_hits": f"""WITH {_HITS} SELECT bin, count(DISTINCT CASE WHEN status = 'accepted' THEN accession END) AS models, count(DISTINCT CASE WHEN status = 'accepted' THEN protein END) AS proteins, count(*) FILTER (status <> 'accepted' OR call <> 'specific') AS review FROM hits GROUP BY 1""",
    "q163_hit_rows": f"""WITH {_HITS}, {sql("orfs")}, pa(component, pathway) AS (VALUES {", ".join(map(str, PANEL))})
SELECT bin, protein, accession, contig, start, stop, coalesce(string_agg(DISTINCT pathway, ';' ORDER BY pathway), '') AS pathways FROM hits JOIN orfs ON orf = protein LEFT JOIN pa USING (component) WHERE status = 'accepted' GROUP BY ALL""",
    "q164b_window_order": f"""WITH {_WINDOWS} SELECT user_id, first_place, last_place, sha256(shown) AS order_sha, genes FROM win""",
    "q164_operons": f"""WITH RECURSIVE {_WINDOWS}, {_CHAINS}
SELECT user_id, first_place, round(score, 6) AS score, orientation, matched_slots, observed FROM (SELECT *, row_number() OVER (PARTITION BY user_id, first_place ORDER BY score DESC, os DESC, ss DESC, turn DESC) AS k FROM judged WHERE used >= 2) WHERE k = 1""",
    "q165_graph_places": f"""WITH {_SEQ}, sg AS (SELECT CASE WHEN id % 5 = 0 THEN 's' || id ELSE 'd' || id END AS segment, length(seq) AS length, CASE WHEN id % 7 = 0 THEN reverse(seq) WHEN id % 11 <> 0 THEN seq END AS sq FROM seqs),
q AS (SELECT 'd' || id AS contig, id, CASE WHEN id % 4 <> 1 THEN CASE WHEN id % 9 = 0 THEN {_RC.format("seq")} ELSE seq END END AS seq, CASE WHEN id % 13 = 0 THEN 's' || id ELSE 'd' || id END AS key, id % 13 = 0 AS rec FROM seqs),
pt AS (SELECT 'd' || id AS path FROM seqs WHERE id % 17 = 0), o AS (SELECT segment, sq AS x, '+' AS o FROM sg WHERE sq IS NOT NULL UNION ALL SELECT segment, {_RC.format("sq")}, '-' FROM sg WHERE sq IS NOT NULL),
mt AS (SELECT q.contig, count(DISTINCT segment) AS hits, min(segment) AS sid, min(o) AS o FROM q LEFT JOIN o ON o.x = q.seq WHERE q.seq IS NOT NULL GROUP BY 1),
j AS (SELECT q.*, path IS NOT NULL AS ip, segment IS NOT NULL AS isg, sq, length AS sl, hits, sid, o, CASE WHEN rec THEN 'recorded_segment' ELSE 'source_segment_name' END AS nm FROM q LEFT JOIN pt ON path = key LEFT JOIN sg ON segment = key LEFT JOIN mt ON mt.contig = q.contig),
k AS (SELECT *, CASE WHEN ip THEN CASE WHEN rec THEN 'recorded_path' ELSE 'source_path_name' END WHEN isg THEN CASE WHEN seq IS NULL THEN nm WHEN seq = sq OR seq = {_RC.format("sq")} THEN nm WHEN sl <> length(seq) THEN 'source_name_length_mismatch' WHEN sq IS NOT NULL THEN 'source_name_sequence_mismatch' ELSE nm END
  WHEN seq IS NULL THEN 'no_recorded_graph_identifier' WHEN hits = 1 THEN 'unique_exact_sequence' WHEN hits > 1 THEN 'ambiguous_exact_sequence' ELSE 'no_exact_segment_match' END AS method FROM j)
SELECT contig, CASE WHEN method IN ('recorded_path','source_path_name','recorded_segment','source_segment_name') THEN key WHEN method = 'unique_exact_sequence' THEN sid END AS place,
  CASE WHEN method = 'unique_exact_sequence' THEN o WHEN method IN ('recorded_segment','source_segment_name') THEN CASE WHEN seq IS NOT NULL AND seq <> sq AND seq = {_RC.format("sq")} THEN '-' ELSE '+' END END AS orient, method FROM k""",
    "q166_induced_graph": """WITH RECURSIVE b AS (SELECT DISTINCT l_partkey AS u, l_suppkey + 1000000000 AS v FROM lineitem WHERE l_quantity > 0), e AS (SELECT u, v FROM b UNION SELECT v, u FROM b),
w AS (SELECT s_suppkey + 1000000000 AS node, CAST(0 AS BIGINT) AS hop FROM supplier WHERE s_nationkey = 7 UNION SELECT v, hop + 1 FROM w JOIN e ON node = u WHERE hop < 2), n AS (SELECT DISTINCT node FROM w)
SELECT v, count(*) AS n FROM b WHERE u IN (SELECT node FROM n) AND v IN (SELECT node FROM n) GROUP BY v""",
    "q58_session_windows": """WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS nw FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, sum(nw) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o), c AS (SELECT user_id, k, count(*) AS n FROM s GROUP BY ALL)
SELECT user_id, count(*) AS sessions, max(n) AS longest FROM c GROUP BY 1""",
}
QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q") and n[1:3].isdigit()}
