"""Queries on graphs, matches and trees, with their SQL: parts and suppliers are segments, order lines their links."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph, select
from ..session import table


def _edges(spark, d):
    line = table(spark, d, "lineitem")
    sign = lambda c: F.when(c, "+").otherwise("-")
    return line.select((F.col("l_partkey") % 500).alias("s"), sign(F.col("l_linenumber") % 2 == 0).alias("so"), (F.col("l_suppkey") % 500).alias("t"), sign(F.col("l_returnflag") == "A").alias("to"))


def q28_edge_dedup(spark, d):
    return graph.canonical_edges(_edges(spark, d))


def _links(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("u"), (F.col("l_suppkey") + 1_000_000_000).alias("v"))


def q29_khop(spark, d):
    seeds = table(spark, d, "supplier").where("s_nationkey = 7").select((F.col("s_suppkey") + 1_000_000_000).alias("node"))
    return graph.within_hops(_links(spark, d), seeds, 1)


def _sequences(spark, d):
    known = "ETAOINSHRDLUBCFGJKMPQVWXYZ"
    letters = F.translate("text", known + known.lower() + " .,\n", 2 * "ACGTACGTACGTACGTACGTACGTAC" + "ACGT")
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.regexp_replace(letters, "[^ACGT]", "N").alias("seq"))


def q30_end_overlaps(spark, d):
    return graph.end_overlaps(_sequences(spark, d), 8)


def q31_unique_match(spark, d):
    seqs = _sequences(spark, d)
    turned = F.when(F.col("id") % 4 == 0, F.col("seq")).when(F.col("id") % 4 == 2, graph.reverse_complement(F.col("seq"))).otherwise(F.concat(F.lit("A"), "seq"))
    other = seqs.select(F.col("id").alias("sid"), turned.alias("seq"))
    return graph.unique_match(seqs.select(F.col("id").alias("qid"), "seq"), other)


def q32_reciprocal_best(spark, d):
    line = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("q"), F.col("l_suppkey").alias("s")).agg(F.max(F.col("l_extendedprice").cast("decimal(18,2)")).alias("score"))
    return select.reciprocal(line, "q", "s", "score", 0.995)


def _tree(spark, d):
    nation, sup = table(spark, d, "nation"), table(spark, d, "supplier")
    return (
        table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("node"), F.lit("root").alias("parent"))
        .unionByName(nation.select(F.concat(F.lit("n"), "n_nationkey").alias("node"), F.concat(F.lit("r"), "n_regionkey").alias("parent")))
        .unionByName(sup.select(F.concat(F.lit("s"), "s_suppkey").alias("node"), F.concat(F.lit("n"), "s_nationkey").alias("parent")))
        .unionByName(spark.range(1).select(F.lit("root").alias("node"), F.lit(None).cast("string").alias("parent")))
    )


def q50_closure(spark, d):
    return graph.closure(_tree(spark, d))


def q50b_common_ancestor(spark, d):
    members = table(spark, d, "lineitem").select("l_partkey", F.concat(F.lit("s"), "l_suppkey").alias("node"))
    return graph.common_ancestor(members, "l_partkey", graph.closure(_tree(spark, d)))


def q50c_share_ancestor(spark, d):
    members = table(spark, d, "lineitem").select("l_partkey", F.concat(F.lit("s"), "l_suppkey").alias("node"))
    return graph.common_ancestor(members, "l_partkey", graph.closure(_tree(spark, d)), 0.7)


def q45_reverse_complement(spark, d):
    return _sequences(spark, d).select("id", F.sha2(graph.reverse_complement(F.col("seq")), 256).alias("rc_sha"), F.length("seq").cast("long").alias("n"))


_SEQ = """seqs AS (SELECT doc_id AS id, regexp_replace(translate(upper(regexp_replace(text, '[^A-Za-z .,\n]', '0', 'g')), 'ETAOINSHRDLUBCFGJKMPQVWXYZ .,' || chr(10), 'ACGTACGTACGTACGTACGTACGTACACGTA'), '[^ACGT]', 'N', 'g') AS seq FROM documents)"""
_RC = "reverse(translate({}, 'ACGTRYSWKMBDHVN', 'TGCAYRSWMKVHDBN'))"
_CANON = """flip AS (SELECT s, so, t, "to", CASE WHEN "to" = '+' THEN '-' ELSE '+' END AS fso, CASE WHEN so = '+' THEN '-' ELSE '+' END AS fto FROM e)
SELECT DISTINCT CASE WHEN k THEN s ELSE t END AS s, CASE WHEN k THEN so ELSE fso END AS so, CASE WHEN k THEN t ELSE s END AS t, CASE WHEN k THEN "to" ELSE fto END AS "to"
FROM (SELECT *, (s, so, t, "to") <= (t, fso, s, fto) AS k FROM flip)"""
_CLOSURE = """edges AS (SELECT 'r' || r_regionkey AS node, 'root' AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
  UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier UNION ALL SELECT 'root', NULL),
tree AS (SELECT node, node AS ancestor, CAST(0 AS BIGINT) AS distance FROM edges UNION ALL SELECT tree.node, parent, distance + 1 FROM tree JOIN edges ON tree.ancestor = edges.node WHERE parent IS NOT NULL)"""
_LCA = f"""WITH RECURSIVE {_CLOSURE}, m AS (SELECT DISTINCT l_partkey, 's' || l_suppkey AS node FROM lineitem), n AS (SELECT l_partkey, count(*) AS n FROM m GROUP BY 1),
h AS (SELECT node, max(distance) AS depth FROM tree GROUP BY 1), c AS (SELECT l_partkey, ancestor, count(*) AS held FROM m JOIN tree USING (node) GROUP BY ALL),
k AS (SELECT l_partkey, ancestor, row_number() OVER (PARTITION BY l_partkey ORDER BY depth DESC, ancestor) AS p FROM c JOIN n USING (l_partkey) JOIN h ON ancestor = h.node WHERE held >= {{share}} * n)
SELECT l_partkey, ancestor AS lca FROM k WHERE p = 1"""

SQL = {
    "q28_edge_dedup": f"""WITH e AS (SELECT l_partkey % 500 AS s, CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS so, l_suppkey % 500 AS t, CASE WHEN l_returnflag = 'A' THEN '+' ELSE '-' END AS "to" FROM lineitem), {_CANON}""",
    "q29_khop": """WITH RECURSIVE b AS (SELECT l_partkey AS u, l_suppkey + 1000000000 AS v FROM lineitem),
e AS (SELECT u, v FROM b UNION SELECT v, u FROM b), w AS (SELECT s_suppkey + 1000000000 AS node, CAST(0 AS BIGINT) AS hop FROM supplier WHERE s_nationkey = 7
UNION SELECT v, hop + 1 FROM w JOIN e ON node = u WHERE hop < 1) SELECT node, min(hop) AS hop FROM w GROUP BY node""",
    "q30_end_overlaps": f"""WITH {_SEQ}, o AS (SELECT id, '+' AS o, seq AS x FROM seqs WHERE length(seq) > 8 UNION ALL SELECT id, '-', {_RC.format('seq')} FROM seqs WHERE length(seq) > 8),
e AS (SELECT a.id AS s, a.o AS so, b.id AS t, b.o AS "to" FROM o a JOIN o b ON right(a.x, 8) = left(b.x, 8) WHERE regexp_full_match(right(a.x, 8), '[ACGT]+')), {_CANON}""",
    "q31_unique_match": f"""WITH {_SEQ}, g AS (SELECT id AS sid, CASE id % 4 WHEN 0 THEN seq WHEN 2 THEN {_RC.format('seq')} ELSE 'A' || seq END AS seq FROM seqs),
b AS (SELECT sid, seq, '+' AS o FROM g UNION ALL SELECT sid, {_RC.format('seq')}, '-' FROM g),
f AS (SELECT q.id AS qid, count(DISTINCT sid) AS hits, min(sid) AS sid, min(o) AS o FROM seqs q LEFT JOIN b ON q.seq = b.seq GROUP BY q.id)
SELECT qid, CASE WHEN hits = 1 THEN sid END AS sid, CASE WHEN hits = 1 THEN o END AS orient, CASE WHEN hits = 1 THEN 'unique_exact_sequence' WHEN hits > 1 THEN 'ambiguous_exact_sequence' ELSE 'no_exact_segment_match' END AS method FROM f""",
    "q32_reciprocal_best": """WITH p AS (SELECT l_partkey AS q, l_suppkey AS s, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS score FROM lineitem GROUP BY ALL),
a AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, s) AS k, lead(score) OVER (PARTITION BY q ORDER BY score DESC, s) AS nx FROM p),
b AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY score DESC, q) AS k, lead(score) OVER (PARTITION BY s ORDER BY score DESC, q) AS nx FROM p)
SELECT a.q, a.s, a.score FROM a JOIN b ON a.q = b.q AND a.s = b.s WHERE a.k = 1 AND b.k = 1 AND (a.nx IS NULL OR a.nx < 0.995 * a.score) AND (b.nx IS NULL OR b.nx < 0.995 * b.score)""",
    "q50_closure": f"WITH RECURSIVE {_CLOSURE} SELECT node, ancestor, distance FROM tree",
    "q50b_common_ancestor": _LCA.format(share=1),
    "q50c_share_ancestor": _LCA.format(share=0.7),
    "q45_reverse_complement": f"WITH {_SEQ} SELECT id, sha256({_RC.format('seq')}) AS rc_sha, length(seq) AS n FROM seqs",
}
QUERIES = {name: globals()[name] for name in SQL}
