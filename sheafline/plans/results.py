"""Queries on result sets, feature sets, trees, caches, layouts of runs, graph files and logs, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, results, trees, votes
from ..session import folder, table
from ..sources import discovery, graphs
from ..streaming import logs
from . import assembly, upkeep

#: The seven tables of a result set: (table, {column: expression}); every expression means the same in Spark and in DuckDB.
SET = {
    "bins": ("nation", {"bin_id": "concat('b', CASE n_nationkey WHEN 13 THEN 12 ELSE n_nationkey END)", "status": "CASE WHEN n_nationkey % 6 = 5 THEN 'failed' ELSE 'done' END"}),
    "definitions": ("region", {"pathway": "concat('p', r_regionkey)", "component": "r_name"}),
    "summary": ("customer", {"bin_id": "concat('b', c_nationkey)", "pathway": "concat('p', c_custkey % 50)", "panel_percent": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'NA' ELSE CAST(CAST(floor(c_acctbal / 90) AS BIGINT) AS {text}) END", "panel_status": "c_mktsegment"}),
    "hits": ("lineitem", {"bin_id": "concat('b', l_suppkey % 27)", "protein": "CAST(l_orderkey AS {text})", "status": "CASE WHEN l_returnflag = 'R' THEN 'fragment' ELSE 'accepted' END", "target_call": "CASE WHEN l_linestatus = 'F' THEN 'specific' ELSE 'family' END"}),
    "components": ("part", {"bin_id": "concat('b', p_size % 26)", "component": "p_brand"}),
    "neighborhoods": ("events", {"bin_id": "concat('b', user_id % 25)"}),
    "operons": ("orders", {"bin_id": "concat('b', o_custkey % 25)"}),
}


def _set(spark, d):
    return {n: table(spark, d, t).selectExpr(*[f"{e.format(text='STRING')} AS {c}" for c, e in cols.items()]) for n, (t, cols) in SET.items()}


_SET_SQL = ", ".join(f"t_{n} AS (SELECT {', '.join(f'{e.format(text=chr(86) + "ARCHAR")} AS {c}' for c, e in cols.items())} FROM {t})" for n, (t, cols) in SET.items())


def q250_result_faults(spark, d):
    """Bins given twice, unknown bins, keys given twice and percentages out of range in seven tables."""
    return results.faults(_set(spark, d))[0]


def _shown(spark, d):
    tables = _set(spark, d)
    nation = table(spark, d, "nation")
    tables["bins"] = nation.selectExpr("concat('b', n_nationkey) AS bin_id", f"{SET['bins'][1]['status']} AS status")
    recorded = nation.where("n_nationkey <> 4").selectExpr("concat('b', n_nationkey) AS bin_id", "CASE WHEN n_nationkey % 5 = 0 THEN 'old' ELSE n_name END AS digest")
    current = nation.where("n_nationkey <> 9").selectExpr("concat('b', n_nationkey) AS bin_id", "n_name AS digest")
    return results.shown(tables, results.bin_states(tables["bins"], recorded, current))


def q251_shown_bins(spark, d):
    return _shown(spark, d)["bins"]


def q252_shown_summary(spark, d):
    """Summary rows by bin and status; those of bins that are not trusted have their state in place of their values."""
    return _shown(spark, d)["summary"].groupBy("bin_id", "panel_status", "route_status").agg(F.count("*").alias("n"), F.sum("panel_percent").alias("percent"))


# A feature's contig is an object, or named under one of two names; a third of the bins have JSON, a third a table.
_FEATURE = """concat('{"type":"', CASE WHEN event_type = 'view' THEN 'CDS' ELSE 'tRNA' END, '","locus":"L', event_id, '","product":"', CASE WHEN value < 3 THEN 'Hypothetical protein' ELSE event_type END, '",',
CASE event_id % 3 WHEN 0 THEN concat('"sequence":{"id":"c', user_id, '"}') WHEN 1 THEN concat('"contig":"c', user_id, '"') ELSE concat('"sequence_id":"c', CASE WHEN user_id % 30 = 3 THEN -1 ELSE user_id END, '"') END,
CASE event_id % 4 WHEN 0 THEN ',"pseudogene":{"description":"cut"}' WHEN 1 THEN ',"pseudo":"no"' ELSE '' END, CASE event_id % 5 WHEN 0 THEN ',"hypothetical":true,"aa":"MK*"' WHEN 1 THEN ',"db_xrefs":["a","b"]' ELSE ',"dbxref":"x"' END, '}')"""


def q253_feature_sets(spark, d):
    """Features of users: from JSON, from a table, or from neither; the first in order of each bin's problems."""
    e = table(spark, d, "events")
    whole = F.concat(F.lit('{"features":['), F.array_join(F.array_sort(F.collect_list(F.struct("event_id", F.expr(_FEATURE).alias("f"))))["f"], ","), F.lit("]}"))
    json = e.where("user_id % 3 = 0").groupBy("user_id").agg(whole.alias("json")).select(F.concat(F.lit("b"), "user_id").alias("bin"), F.when(F.col("user_id") % 30 == 0, F.lit('{"features":[{"type"')).otherwise(F.col("json")).alias("json"))
    tsv = e.where("user_id % 3 <> 2").selectExpr("concat('b', user_id) AS bin", "event_id AS number", "CASE WHEN user_id % 50 = 1 AND event_id % 2 = 0 THEN 'other' END AS own_bin", "concat('L', event_id) AS locus", "'' AS gene", "event_type AS product", "CASE WHEN event_type = 'view' THEN 'CDS' ELSE 'tRNA' END AS kind", "concat('c', user_id) AS contig", "'1' AS start", "'9' AS stop", "'+' AS strand", "'' AS refs")
    seqs = e.where("event_type = 'view'").selectExpr("concat('b', user_id) AS bin", "concat('L', event_id) AS locus", "'aa' AS field", "repeat('M', CAST(event_id % 7 + 1 AS INT)) AS seq")
    bins = e.selectExpr("concat('b', user_id) AS bin").distinct()
    contigs = e.selectExpr("concat('b', user_id) AS bin", "concat('c', user_id) AS contig").distinct()
    made, per = features.feature_sets(bins, json, tsv, seqs, contigs)
    yes = lambda c: F.count(F.when(F.col(c), 1)).alias(c)
    told = made.groupBy("bin").agg(yes("hypothetical"), yes("pseudogene"), F.count(F.when(F.col("pseudogene_note") == "cut", 1)).alias("cut"), F.sum("aa_length").alias("aa"), F.count(F.when(F.col("refs") == "a;b", 1)).alias("refs"), F.count_distinct("contig").alias("contigs"))
    return per.join(told, "bin", "left")


def q254_trees(spark, d):
    """A tree for each customer: orders with their lines as leaves, written in Newick form and parsed again."""
    line, orders = table(spark, d, "lineitem"), table(spark, d, "orders").select("o_orderkey", "o_custkey")
    leaf = F.concat(F.lit("l"), "l_linenumber", F.lit(":"), F.floor("l_quantity").cast("long"))
    per = line.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list(leaf)), ","), F.lit(")'o '' "), F.first("l_orderkey"), F.lit("':"), F.count("*")).alias("t"))
    whole = per.join(orders, "o_orderkey").groupBy("o_custkey").agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list("t")), ", "), F.lit(")c"), F.first("o_custkey"), F.lit(";")).alias("text"))
    n = trees.nodes(whole, "o_custkey", "text")
    up = n.select(F.col("o_custkey").alias("_t"), F.col("node").alias("_n"), F.col("label").alias("parent_label"))
    j = n.join(up, (F.col("o_custkey") == F.col("_t")) & (F.col("parent") == F.col("_n")), "left")
    return j.groupBy("o_custkey", "label", "parent_label", "depth", "leaf").agg(F.count("*").alias("n"), F.sum("length").alias("length"))


def q255_cached_votes(spark, d):
    """Votes of which two thirds come from a cache that knew other scores for every third contig."""
    hits = assembly._hits(spark, d)
    vote = lambda h: votes.rank_votes(h, "o_custkey", ["region", "nation"], "names", "score", assembly.LINE).withColumn("rank", F.col("rank").cast("long"))
    earlier = hits.withColumn("score", F.when(F.col("o_custkey") % 3 == 0, (F.col("score") * 2).cast("decimal(18,2)")).otherwise(F.col("score")))
    cache, _ = votes.cached_votes(earlier, "o_custkey", vote)
    return votes.cached_votes(hits, "o_custkey", vote, cache)[0].drop("fingerprint")


_PATH = """CASE c_custkey % 8 WHEN 0 THEN concat('bins/genus/b', c_custkey, '.fasta') WHEN 1 THEN concat(CASE WHEN c_nationkey % 2 = 0 THEN 'final/' ELSE '' END, 'bins/species/b', c_custkey, '.fasta')
WHEN 2 THEN concat(CASE WHEN c_nationkey % 2 = 0 THEN 'final/' ELSE '' END, 'annotation/species/b', c_custkey - 1, '/features.tsv') WHEN 3 THEN concat('annotation/genus/b', c_custkey - 3, '/bakta/annotation.json')
WHEN 4 THEN 'classification/contig_classification.tsv' WHEN 5 THEN 'final/classification/bin_refinement.tsv' WHEN 6 THEN 'final/binarena/binarena_input.tsv' ELSE concat('notes/', c_custkey, '.txt') END"""


def _files(spark, d):
    return table(spark, d, "customer").selectExpr("concat('run', c_nationkey) AS run", f"{_PATH} AS path", "CAST(0 AS BIGINT) AS size").distinct()


def q256_run_layout(spark, d):
    """The parts of each run's preferred stage."""
    return discovery.preferred(discovery.parts(_files(spark, d))).select("run", "stage", "part", "rank", "name", "path")


def q257_missing_parts(spark, d):
    return discovery.missing(discovery.preferred(discovery.parts(_files(spark, d))))


def q258_path_offsets(spark, d):
    """Orders as paths and walks over parts, written as a graph file and read again, with the place of each step."""
    part = table(spark, d, "part").select(F.concat_ws("\t", F.lit("S"), "p_partkey", F.lit("*"), F.concat(F.lit("LN:i:"), "p_size"), F.lit("dp:f:1.5")).alias("value"))
    line = table(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("x"), F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("o"))
    per = line.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("x", "o"))).alias("s"))
    path = F.concat_ws("\t", F.lit("P"), "l_orderkey", F.array_join(F.transform("s", lambda x: F.concat(x["x"]["l_partkey"], x["o"])), ","), F.lit("*"))
    walk = F.concat_ws("\t", F.lit("W"), F.lit("s"), F.lit("1"), "l_orderkey", F.lit("0"), F.lit("9"), F.array_join(F.transform("s", lambda x: F.concat(F.when(x["o"] == "+", ">").otherwise("<"), x["x"]["l_partkey"])), ""))
    at = folder(spark)
    spark.range(1).select(F.lit("H\tVN:Z:1.0").alias("value")).unionByName(part).unionByName(per.select(F.when(F.col("l_orderkey") % 2 == 0, path).otherwise(walk).alias("value"))).write.text(at)
    got = graphs.graph(spark, at)
    return graphs.step_offsets(got["path_steps"], got["segments"]).select("path", F.col("i").cast("long").alias("i"), "segment", "orient", "start", "end")


def q259_log_stream(spark, d):
    """The last record of each key of logs of which some lines are cut off, followed as a stream."""
    e = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    whole = F.to_json(F.struct("user_id", "event_type", "event_id", F.col("ts").cast("string").alias("ts"), "value"))
    at = folder(spark)
    e.select(F.explode(F.array_compact(F.array(whole, F.when(F.col("event_id") % 10 == 0, F.substring(whole, 1, 20))))).alias("value")).repartition(4).write.text(at)
    out = folder(spark)
    for q in logs.follow(spark, at, out, "user_id long, event_type string, event_id long, ts timestamp, value double", ["user_id", "event_type"], ["ts", "event_id"], files=2):
        q.awaitTermination()
    return logs.current(spark, out).select("user_id", "event_type", "event_id", "value")


_UNKNOWN = " UNION ALL ".join(f"SELECT '{n}' AS \"table\", bin_id AS key, 'unknown bin' AS problem, count(*) AS n FROM t_{n} WHERE bin_id NOT IN (SELECT bin_id FROM t_bins) GROUP BY bin_id" for n, (_, c) in SET.items() if "bin_id" in c and n != "bins")
_STATES = f"""nb AS (SELECT concat('b', n_nationkey) AS bin_id, {SET["bins"][1]["status"]} AS status, CASE WHEN n_nationkey = 9 THEN 'missing_bin' WHEN n_nationkey = 4 THEN 'unverified' WHEN n_nationkey % 5 = 0 THEN 'stale_input' ELSE 'current' END AS source_state FROM nation),
st AS (SELECT *, source_state = 'current' AND status <> 'failed' AS trusted FROM nb)"""
_FILES = f"""f AS (SELECT DISTINCT concat('run', c_nationkey) AS run, {_PATH} AS path FROM customer), pa AS (SELECT *, CASE WHEN path LIKE 'final/%' THEN 'final' ELSE 'preliminary' END AS stage, CASE WHEN path LIKE 'final/%' THEN substring(path, 7) ELSE path END AS b FROM f),
pt AS (SELECT run, stage, path, CASE WHEN b LIKE 'bins/%' THEN 'bin' WHEN b LIKE '%/features.tsv' THEN 'features' WHEN b LIKE '%/annotation.json' THEN 'annotation' WHEN b LIKE '%contig_classification.tsv' THEN 'classification' WHEN b LIKE '%bin_refinement.tsv' THEN 'refinement' WHEN b LIKE '%binarena_input.tsv' THEN 'feature_table' END AS part,
  CASE WHEN b LIKE 'bins/%' OR b LIKE 'annotation/%' THEN split_part(b, '/', 2) END AS rank, CASE WHEN b LIKE 'bins/%' OR b LIKE 'annotation/%' THEN replace(split_part(b, '/', 3), '.fasta', '') END AS name FROM pa),
fi AS (SELECT run, max(stage = 'final' AND part = 'bin') AS has FROM pt WHERE part IS NOT NULL GROUP BY 1), pr AS (SELECT pt.* FROM pt JOIN fi USING (run) WHERE part IS NOT NULL AND (stage = 'final') = has)"""

SQL = {
    "q250_result_faults": f"""WITH {_SET_SQL} SELECT 'bins' AS "table", bin_id AS key, 'given more than once' AS problem, count(*) AS n FROM t_bins GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'summary', bin_id || '/' || pathway, 'given more than once', count(*) FROM t_summary GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'components', bin_id || '/' || component, 'given more than once', count(*) FROM t_components GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'summary', bin_id || '/' || pathway, 'percentage outside 0-100', count(*) FROM t_summary WHERE TRY_CAST(panel_percent AS DOUBLE) NOT BETWEEN 0 AND 100 GROUP BY 2 UNION ALL {_UNKNOWN}""",
    "q251_shown_bins": f"""WITH {_SET_SQL}, {_STATES} SELECT st.bin_id, st.status, source_state, trusted, count(*) FILTER (trusted AND h.status = 'accepted') AS accepted_models, count(DISTINCT CASE WHEN trusted AND h.status = 'accepted' THEN protein END) AS accepted_proteins,
count(*) FILTER (trusted AND (h.status <> 'accepted' OR target_call <> 'specific')) AS review_hits FROM st LEFT JOIN t_hits h ON h.bin_id = st.bin_id GROUP BY ALL""",
    "q252_shown_summary": f"""WITH {_SET_SQL}, {_STATES}, j AS (SELECT s.bin_id, CASE WHEN trusted THEN panel_status WHEN status = 'failed' THEN 'bin_failed' ELSE source_state END AS panel_status, CASE WHEN NOT trusted THEN CASE WHEN status = 'failed' THEN 'bin_failed' ELSE source_state END END AS route_status,
CASE WHEN trusted THEN TRY_CAST(panel_percent AS DOUBLE) END AS p FROM t_summary s JOIN st ON st.bin_id = s.bin_id) SELECT bin_id, panel_status, route_status, count(*) AS n, sum(p) AS percent FROM j GROUP BY ALL""",
    "q253_feature_sets": """WITH e AS (SELECT *, event_type = 'view' AS cds, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events), u AS (SELECT DISTINCT user_id FROM events),
er AS (SELECT user_id, CASE WHEN user_id % 30 = 0 THEN 'no features array' WHEN user_id % 30 = 3 THEN 'feature ' || min(CASE WHEN event_id % 3 = 2 THEN k END) || ' is on a contig outside the bin: c-1' WHEN user_id % 3 = 1 AND user_id % 50 = 1 THEN 'row ' || min(CASE WHEN event_id % 2 = 0 THEN event_id END) || ' belongs to a different bin' END AS error FROM e GROUP BY 1),
f AS (SELECT e.*, user_id % 3 = 0 AS js FROM e JOIN er USING (user_id) WHERE error IS NULL AND user_id % 3 <> 2),
t AS (SELECT user_id, count(*) AS features, count(*) FILTER (cds AND js AND (event_id % 5 = 0 OR value < 3)) AS hypothetical, count(*) FILTER (js AND event_id % 4 = 0) AS pseudogene, count(*) FILTER (js AND event_id % 4 = 0) AS cut,
  CAST(sum(CASE WHEN js AND event_id % 5 = 0 THEN 2 WHEN cds THEN event_id % 7 + 1 END) AS BIGINT) AS aa, count(*) FILTER (js AND event_id % 5 = 1) AS refs, CAST(1 AS BIGINT) AS contigs FROM f GROUP BY 1)
SELECT 'b' || user_id AS bin, CASE user_id % 3 WHEN 0 THEN 'json' WHEN 1 THEN 'table' ELSE 'none' END AS source, coalesce(features, 0) AS features, coalesce(error, '') AS error, hypothetical, pseudogene, cut, aa, refs, contigs FROM u JOIN er USING (user_id) LEFT JOIN t USING (user_id)""",
    "q254_trees": """WITH l AS (SELECT o_custkey, l_orderkey, l_linenumber, CAST(floor(l_quantity) AS DOUBLE) AS q FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT o_custkey, 'l' || l_linenumber AS label, 'o '' ' || l_orderkey AS parent_label, CAST(2 AS BIGINT) AS depth, true AS leaf, count(*) AS n, sum(q) AS length FROM l GROUP BY ALL
UNION ALL SELECT o_custkey, 'o '' ' || l_orderkey, 'c' || o_custkey, 1, false, 1, CAST(count(*) AS DOUBLE) FROM l GROUP BY o_custkey, l_orderkey UNION ALL SELECT DISTINCT o_custkey, 'c' || o_custkey, NULL, 0, false, 1, CAST(NULL AS DOUBLE) FROM l""",
    "q255_cached_votes": assembly.SQL["q01_rank_vote_all"],
    "q256_run_layout": f"WITH {_FILES} SELECT run, stage, part, rank, name, path FROM pr",
    "q257_missing_parts": f"""WITH {_FILES}, r AS (SELECT DISTINCT run FROM pr) SELECT run, part, CAST(NULL AS VARCHAR) AS rank, CAST(NULL AS VARCHAR) AS name FROM r CROSS JOIN (VALUES ('classification'), ('refinement'), ('feature_table')) x(part) WHERE NOT EXISTS (SELECT 1 FROM pr WHERE pr.run = r.run AND pr.part = x.part)
UNION ALL SELECT run, 'annotation', rank, name FROM pr b WHERE part = 'bin' AND EXISTS (SELECT 1 FROM pr a WHERE a.run = b.run AND a.rank = b.rank AND a.part IN ('features', 'annotation')) AND NOT EXISTS (SELECT 1 FROM pr a WHERE a.run = b.run AND a.rank = b.rank AND a.name = b.name AND a.part IN ('features', 'annotation'))""",
    "q258_path_offsets": """WITH l AS (SELECT l_orderkey, l_partkey, l_returnflag, p_size, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT CASE WHEN l_orderkey % 2 = 0 THEN CAST(l_orderkey AS VARCHAR) ELSE 's#1#' || l_orderkey || '#0#9' END AS path, k - 1 AS i, CAST(l_partkey AS VARCHAR) AS segment, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS orient,
CAST(sum(p_size) OVER w - p_size AS BIGINT) AS start, CAST(sum(p_size) OVER w AS BIGINT) AS "end" FROM l WINDOW w AS (PARTITION BY l_orderkey ORDER BY k)""",
    "q259_log_stream": upkeep.SQL["q60_latest_record"],
}
QUERIES = {n: f for n, f in list(globals().items()) if n[0] == "q" and n[1:2].isdigit()}
