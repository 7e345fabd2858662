"""Queries on votes, metrics, intervals and partitions, with their SQL.

The given tables stand in for assembly tables: customers are contigs, orders are open reading frames, order lines are
hits with their price as score, suppliers and customers give the taxa, and documents are sequences with a length.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals, metrics, partition, votes
from ..session import table

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
LINE_SQL = ", ".join(LINE)


def _hits(spark, d):
    line, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", F.when(F.col("r_name") != "EUROPE", F.col("r_name")).alias("region"), F.col("n_name").alias("nation"))
    of = lambda df, key, out: df.join(places, df[key] == places["n_nationkey"]).select(df.columns[0], F.struct("region", "nation").alias(out))
    sup, cus = of(table(spark, d, "supplier"), "s_nationkey", "sn"), of(table(spark, d, "customer"), "c_nationkey", "cn")
    top = votes.best_hits(line.withColumn("score", F.col("l_extendedprice").cast("decimal(18,2)")), "l_orderkey", "score", LINE)
    joined = top.join(orders, top["l_orderkey"] == orders["o_orderkey"]).join(sup, top["l_suppkey"] == sup["s_suppkey"]).join(cus, orders["o_custkey"] == cus["c_custkey"])
    return joined.select("o_custkey", "score", *LINE, F.array("sn", "cn").alias("names"))


def q01_rank_vote_all(spark, d, denominator="all"):
    return votes.rank_votes(_hits(spark, d), "o_custkey", ["region", "nation"], "names", "score", LINE, 0.5, denominator).withColumn("rank", F.col("rank").cast("long"))


def q01b_rank_vote_named(spark, d):
    return q01_rank_vote_all(spark, d, "named")


def _vote_sql(total):
    return f"""
WITH places AS (SELECT n_nationkey, CASE WHEN r_name <> 'EUROPE' THEN r_name END AS region, n_name AS nation FROM nation JOIN region ON n_regionkey = r_regionkey),
l AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS score FROM lineitem),
near AS (SELECT *, max(score) OVER (PARTITION BY l_orderkey) AS best FROM l),
top AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, {LINE_SQL}) AS k FROM near WHERE best > 0 AND score >= 0.9 * best),
hits AS (SELECT row_number() OVER (ORDER BY {LINE_SQL}) AS ord, o_custkey, score, sp.region AS r1, cp.region AS r2, sp.nation AS n1, cp.nation AS n2
  FROM top JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN places sp ON s_nationkey = sp.n_nationkey
  JOIN customer ON o_custkey = c_custkey JOIN places cp ON c_nationkey = cp.n_nationkey WHERE k <= 5),
long AS (SELECT ord, o_custkey, score, 0 AS rank, r1 AS a, r2 AS b FROM hits UNION ALL SELECT ord, o_custkey, score, 1, n1, n2 FROM hits),
total AS (SELECT o_custkey, rank, {total} AS total FROM long GROUP BY ALL),
parts AS (SELECT ord, 0 AS k, o_custkey, rank, a AS taxon, CASE WHEN b IS NULL OR a = b THEN score ELSE CAST(score * 0.5 AS DECIMAL(24,6)) END AS part FROM long WHERE a IS NOT NULL
  UNION ALL SELECT ord, 1, o_custkey, rank, b, CASE WHEN a IS NULL THEN score ELSE CAST(score * 0.5 AS DECIMAL(24,6)) END FROM long WHERE b IS NOT NULL AND (a IS NULL OR a <> b)),
w AS (SELECT o_custkey, rank, taxon, sum(CAST(part AS DECIMAL(24,6))) AS weight, min(ord * 2 + k) AS first FROM parts GROUP BY ALL),
won AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, rank ORDER BY weight DESC, first) AS p FROM w)
SELECT t.o_custkey, CAST(t.rank AS BIGINT) AS rank, CASE WHEN 2 * weight >= total THEN taxon ELSE 'Unclassified' END AS taxon,
  CASE WHEN total > 0 THEN coalesce(round(CAST(weight AS DOUBLE) / CAST(total AS DOUBLE), 4), 0.0) ELSE 0.0 END AS support
FROM total t LEFT JOIN won ON t.o_custkey = won.o_custkey AND t.rank = won.rank AND p = 1"""


def q02_n50_l50(spark, d):
    return metrics.nx_lx(table(spark, d, "documents"), ["source"], "n_chars")


def q02b_nx_lx(spark, d):
    docs = table(spark, d, "documents")
    return metrics.nx_lx(docs, ["lang"], "n_chars", (50, 90)).join(metrics.summary(docs, ["lang"], "n_chars"), "lang")


def q03_rank_totals(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return metrics.rank_totals(docs, "source", "n_chars", F.col("quality").isNotNull(), "doc_id")


def q04_length_filter(spark, d):
    long = F.col("n_chars") >= 1000
    flag = lambda c, v: F.sum(F.when(c, v).otherwise(0)).cast("long")
    return table(spark, d, "documents").groupBy("lang").agg(flag(long, 1).alias("kept"), flag(long, F.col("n_chars")).alias("kept_bp"), flag(~long, 1).alias("removed"), flag(~long, F.col("n_chars")).alias("removed_bp"))


def q05_islands(spark, d):
    return intervals.islands(table(spark, d, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag"], "l_returnflag")


def _intervals(spark, d):
    return table(spark, d, "lineitem").select("l_suppkey", F.col("l_partkey").alias("lo"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("hi"))


def q06_interval_union(spark, d):
    return intervals.union_length(_intervals(spark, d), ["l_suppkey"], "lo", "hi")


def q06b_interval_union_inclusive(spark, d):
    return intervals.union_length(_intervals(spark, d), ["l_suppkey"], "lo", "hi", inclusive=True)


def q07_interval_overlap(spark, d):
    line = table(spark, d, "lineitem")
    genes = line.where("l_returnflag = 'A'").select("l_suppkey", F.col("l_partkey").alias("l_lo"), (F.col("l_partkey") + 20).alias("l_hi"))
    regions = line.where("l_returnflag = 'N' AND l_linenumber = 1").select("l_suppkey", F.col("l_partkey").alias("r_lo"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("r_hi"))
    pairs = intervals.overlap_join(genes, regions, "l_suppkey", 64)
    return pairs.groupBy("l_suppkey").agg(F.count("*").cast("long").alias("pairs"), F.sum(F.least("l_hi", "r_hi") - F.greatest("l_lo", "r_lo") + 1).cast("long").alias("shared_bp"))


def q08_tumbling_profile(spark, d):
    minutes = table(spark, d, "events").select("user_id", (F.hour("ts") * 60 + F.minute("ts")).alias("pos"), F.lit(1).alias("depth"))
    return metrics.profile(minutes, "user_id", "pos", "depth", 1440, 100)


def q09_median_mad(spark, d):
    rows = table(spark, d, "events").select("event_type", F.col("value").cast("decimal(18,2)").alias("v"))
    centre = metrics.robust(rows.select("event_type", F.col("v").cast("double").alias("v")), ["event_type"], "v")
    return centre.select("event_type", F.round("med", 4).alias("med"), F.round("mad", 4).alias("mad"))


def _calls(spark, d):
    cus, nation, region = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    j = cus.join(nation, cus["c_nationkey"] == nation["n_nationkey"]).join(region, nation["n_regionkey"] == region["r_regionkey"])
    return j.select(
        "c_custkey", F.when(F.col("c_custkey") % 11 != 0, F.col("r_name")).alias("domain"), F.when(F.col("c_custkey") % 3 != 0, F.col("n_name")).alias("family"),
        F.when(F.col("c_custkey") % 5 != 0, F.concat_ws("-", "n_name", "c_mktsegment")).alias("genus"), F.abs(F.col("c_acctbal")).cast("long").alias("bp"),
    )


def _labelled(spark, d):
    suffix = F.when(F.col("domain") == "ASIA", "bacterium").when(F.col("domain") == "EUROPE", "archaeon").otherwise("organism")
    return _calls(spark, d).withColumn("options", partition.labels(["domain", "family", "genus"], suffix))


def q10_fallback_labels(spark, d):
    return _labelled(spark, d).select("c_custkey", F.element_at("options", -1)["label"].alias("label"), F.element_at("options", -1)["level"].cast("long").alias("level"))


def q11_cascade_partition(spark, d):
    labelled = partition.cascade(_labelled(spark, d).select("c_custkey", "bp", "options"), "bp", 60_000, rounds=3)
    return labelled.groupBy("label").agg(F.count("*").cast("long").alias("contigs"), F.sum("bp").cast("long").alias("bp"))


_OPTIONS = """
calls AS (SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN r_name END AS domain, CASE WHEN c_custkey % 3 <> 0 THEN n_name END AS family,
  CASE WHEN c_custkey % 5 <> 0 THEN n_name || '-' || c_mktsegment END AS genus, CAST(trunc(abs(c_acctbal)) AS BIGINT) AS bp
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
opts AS (SELECT *, CASE WHEN domain = 'ASIA' THEN 'bacterium' WHEN domain = 'EUROPE' THEN 'archaeon' ELSE 'organism' END AS sfx FROM calls),
l0 AS (SELECT *, CASE WHEN domain IS NOT NULL THEN 'unclassified ' || domain ELSE 'Unclassified' END AS o0, CASE WHEN domain IS NOT NULL THEN 0 ELSE -1 END AS v0 FROM opts),
l1 AS (SELECT *, CASE WHEN family IS NOT NULL THEN family || ' ' || sfx ELSE o0 END AS o1, CASE WHEN family IS NOT NULL THEN 1 ELSE v0 END AS v1 FROM l0),
l2 AS (SELECT *, coalesce(genus, o1) AS o2, CASE WHEN genus IS NOT NULL THEN 2 ELSE v1 END AS v2 FROM l1)"""


def _round_sql(k):
    return f"""
p{k} AS (SELECT lab, sum(bp) AS s, max(lev) AS top FROM r{k} GROUP BY lab),
r{k + 1} AS (SELECT r.* EXCLUDE (lab, lev), CASE WHEN s < 60000 AND top > 0 AND r.lab <> 'Unclassified' THEN CASE lev WHEN 2 THEN o1 WHEN 1 THEN o0 ELSE 'Unclassified' END ELSE r.lab END AS lab,
  CASE WHEN s < 60000 AND top > 0 AND r.lab <> 'Unclassified' THEN CASE lev WHEN 2 THEN v1 WHEN 1 THEN v0 ELSE -1 END ELSE lev END AS lev FROM r{k} r JOIN p{k} ON r.lab = p{k}.lab)"""


def q12_consensus(spark, d):
    hits = _hits(spark, d)
    nation = F.col("names")[0]["nation"]
    return votes.unanimous(hits.select("o_custkey", F.when(F.col("score") > 40000, nation).otherwise(F.lit(votes.UNCLASSIFIED)).alias("taxon")), ["o_custkey"], "taxon")


def q13_majority(spark, d):
    line = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_quantity").cast("long").alias("q"))
    return votes.majority(line, ["l_suppkey"], "l_returnflag", "q")


def q14_prefilter_case(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    density = F.col("n_chars") % 100 / 100.0
    kingdom = F.when(F.col("toxic") == 1, "eukarya").when(F.col("quality") == 1, "bacteria").when(F.col("quality") == 0, "organelle").otherwise("unknown")
    decision = F.when(kingdom == "bacteria", "search").when(kingdom == "eukarya", "skip_eukarya").when(density > 0.4, "search_rescued_coding_density").when(kingdom == "organelle", "skip_organelle").otherwise("skip_unknown")
    marked = docs.withColumn("decision", decision)
    return marked.groupBy("decision").agg(F.count("*").cast("long").alias("contigs"), F.sum("n_chars").cast("long").alias("bp"))


def q15_acceptance_gate(spark, d):
    line = table(spark, d, "lineitem")
    per = line.groupBy("l_orderkey").agg(F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).otherwise(0)).cast("long").alias("after"), F.sum("l_quantity").cast("long").alias("before"), F.max("l_quantity").cast("long").alias("n50"))
    kept = F.col("after") / F.col("before")
    out = F.when(kept < 0.5, "rejected_sequence_loss").when(F.col("n50") * 2 > F.col("before") * 1.25, "rejected_length_inflation").when(F.col("n50") > 30, "accepted").otherwise("rejected_no_gain")
    return per.groupBy(out.alias("outcome")).agg(F.count("*").cast("long").alias("bins"), F.sum("before").cast("long").alias("bp"))


def q16_eligibility(spark, d):
    orders = table(spark, d, "orders").withColumn("label", F.when(F.col("o_orderstatus") == "P", "Unclassified").when(F.col("o_orderpriority").startswith("5"), F.concat(F.lit("unclassified_"), "o_orderstatus")).otherwise(F.col("o_orderpriority")))
    per = orders.groupBy("label", "o_orderstatus").agg(F.count("*").cast("long").alias("contigs"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    reason = F.when(F.col("label").startswith("unclassified_"), "skip_unclassified").when(F.col("o_orderstatus") == "O", "skip_domain").when(F.col("v") > 100_000_000, "skip_size").otherwise("eligible")
    return per.where("label <> 'Unclassified'").select("label", "o_orderstatus", "contigs", reason.alias("decision"))


def q27_partition_verify(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    bins = labels.where("quality = 1").select("doc_id", F.lit("good").alias("bin")).unionByName(labels.where("toxic = 1").select("doc_id", F.lit("toxic").alias("bin")))
    return partition.verify(docs.select("doc_id", "n_chars"), bins, "doc_id", "n_chars", "bin")


def q49_dictionary(spark, d):
    return partition.dictionary(table(spark, d, "documents"), "lang", "doc_id")


UNION_SQL = """
WITH iv AS (SELECT DISTINCT l_suppkey, l_partkey AS lo, l_partkey + CAST(trunc(l_quantity) AS BIGINT) AS hi FROM lineitem),
w AS (SELECT *, max(hi) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM iv)
SELECT l_suppkey, CAST(sum(greatest(0, hi + {one} - greatest(lo, coalesce(top + {one}, lo)))) AS BIGINT) AS union_bp,
  CAST(sum(CASE WHEN top IS NULL OR lo > top + {one} THEN 1 ELSE 0 END) AS BIGINT) AS islands FROM w GROUP BY l_suppkey"""
RUNS = """WITH r AS (SELECT {g}, n_chars, row_number() OVER w AS k, sum(n_chars) OVER w AS run, sum(n_chars) OVER (PARTITION BY {g}) AS total FROM documents
  WINDOW w AS (PARTITION BY {g} ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING))"""

def _nx(x):
    return f"CAST(max(CASE WHEN 100 * run >= {x} * total THEN n_chars END) AS BIGINT) AS n{x}, CAST(min(CASE WHEN 100 * run >= {x} * total THEN k END) AS BIGINT) AS l{x}"


SQL = {
    "q01_rank_vote_all": _vote_sql("sum(score)"),
    "q01b_rank_vote_named": _vote_sql("sum(CASE WHEN a IS NOT NULL OR b IS NOT NULL THEN score ELSE 0 END)"),
    "q02_n50_l50": RUNS.format(g="source") + f" SELECT source, {_nx(50)} FROM r GROUP BY source",
    "q02b_nx_lx": RUNS.format(g="lang")
    + f""", a AS (SELECT lang, {_nx(50)}, {_nx(90)} FROM r GROUP BY lang),
b AS (SELECT lang, count(*) AS contigs, CAST(sum(n_chars) AS BIGINT) AS bp, max(n_chars) AS longest, min(n_chars) AS shortest, round(avg(n_chars), 4) AS mean_len, CAST(median(n_chars) AS DOUBLE) AS median_len FROM documents GROUP BY lang)
SELECT * FROM a JOIN b USING (lang)""",
    "q03_rank_totals": """SELECT source, count(*) AS bins, CAST(sum(CASE WHEN quality IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS classified, CAST(sum(n_chars) AS BIGINT) AS bp,
  round(CAST(sum(CASE WHEN quality IS NOT NULL THEN n_chars ELSE 0 END) AS DOUBLE) / sum(n_chars), 6) AS classified_fraction, arg_min(doc_id, (-n_chars, doc_id)) AS largest
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
    "q04_length_filter": """SELECT lang, count(*) FILTER (n_chars >= 1000) AS kept, CAST(coalesce(sum(n_chars) FILTER (n_chars >= 1000), 0) AS BIGINT) AS kept_bp,
  count(*) FILTER (n_chars < 1000) AS removed, CAST(coalesce(sum(n_chars) FILTER (n_chars < 1000), 0) AS BIGINT) AS removed_bp FROM documents GROUP BY lang""",
    "q05_islands": """WITH m AS (SELECT l_suppkey, l_returnflag, CASE WHEN lag(l_returnflag) OVER w = l_returnflag THEN 0 ELSE 1 END AS n FROM lineitem
  WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag))
SELECT l_suppkey, CAST(sum(n) AS BIGINT) AS runs, count(DISTINCT l_returnflag) AS distinct_values, CAST(sum(n) - count(DISTINCT l_returnflag) AS BIGINT) AS noncontiguous FROM m GROUP BY l_suppkey""",
    "q06_interval_union": UNION_SQL.format(one=0),
    "q06b_interval_union_inclusive": UNION_SQL.format(one=1),
    "q07_interval_overlap": """SELECT l_suppkey, count(*) AS pairs, CAST(sum(least(l_hi, r_hi) - greatest(l_lo, r_lo) + 1) AS BIGINT) AS shared_bp
FROM (SELECT l_suppkey, l_partkey AS l_lo, l_partkey + 20 AS l_hi FROM lineitem WHERE l_returnflag = 'A')
JOIN (SELECT l_suppkey, l_partkey AS r_lo, l_partkey + CAST(trunc(l_quantity) AS BIGINT) AS r_hi FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber = 1) USING (l_suppkey)
WHERE l_hi >= r_lo AND l_lo <= r_hi GROUP BY l_suppkey""",
    "q08_tumbling_profile": """WITH e AS (SELECT user_id, hour(ts) * 60 + minute(ts) AS pos FROM events), u AS (SELECT user_id, count(*) AS total FROM e GROUP BY user_id),
g AS (SELECT user_id, total, w, least(100, 1440 - w * 100) AS width FROM u, range(15) t(w)), c AS (SELECT user_id, pos // 100 AS w, count(*) AS n, count(DISTINCT pos) AS cov FROM e GROUP BY ALL),
m AS (SELECT g.user_id, CAST(g.w AS BIGINT) AS window_no, coalesce(n, 0) / CAST(width AS DOUBLE) AS mean, coalesce(cov, 0) / CAST(width AS DOUBLE) AS cov, total / CAST(1440 AS DOUBLE) AS whole
  FROM g LEFT JOIN c ON g.user_id = c.user_id AND g.w = c.w)
SELECT user_id, window_no, round(mean, 6) AS mean_depth, round(cov, 6) AS covered_fraction,
  CASE WHEN mean = 0 THEN 'zero_coverage' WHEN mean < 0.2 * whole THEN 'low_relative_depth' WHEN mean > 3 * whole THEN 'high_relative_depth' ELSE '' END AS flag FROM m""",
    "q09_median_mad": """WITH v AS (SELECT event_type, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS v FROM events), c AS (SELECT event_type, median(v) AS med FROM v GROUP BY event_type)
SELECT event_type, round(any_value(med), 4) AS med, round(median(abs(v - med)), 4) AS mad FROM v JOIN c USING (event_type) GROUP BY event_type""",
    "q10_fallback_labels": f"WITH {_OPTIONS} SELECT c_custkey, o2 AS label, CAST(v2 AS BIGINT) AS level FROM l2",
    "q11_cascade_partition": f"WITH {_OPTIONS}, r0 AS (SELECT *, o2 AS lab, v2 AS lev FROM l2), {_round_sql(0)}, {_round_sql(1)}, {_round_sql(2)} SELECT lab AS label, count(*) AS contigs, CAST(sum(bp) AS BIGINT) AS bp FROM r3 GROUP BY lab",
    "q12_consensus": f"""WITH l AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS score FROM lineitem), near AS (SELECT *, max(score) OVER (PARTITION BY l_orderkey) AS best FROM l),
top AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, {LINE_SQL}) AS k FROM near WHERE best > 0 AND score >= 0.9 * best),
c AS (SELECT o_custkey, CASE WHEN score > 40000 THEN n_name END AS t FROM top JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN customer ON o_custkey = c_custkey WHERE k <= 5)
SELECT o_custkey, CASE WHEN min(t) = max(t) THEN min(t) ELSE 'Unclassified' END AS taxon, CASE WHEN min(t) = max(t) THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS support FROM c GROUP BY o_custkey""",
    "q13_majority": """WITH s AS (SELECT l_suppkey, l_returnflag, CAST(sum(trunc(l_quantity)) AS BIGINT) AS held FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY held DESC, l_returnflag) AS k FROM s) SELECT l_suppkey, l_returnflag, held FROM r WHERE k = 1""",
    "q14_prefilter_case": """WITH k AS (SELECT n_chars, (n_chars % 100) / 100.0 AS density, CASE WHEN toxic = 1 THEN 'eukarya' WHEN quality = 1 THEN 'bacteria' WHEN quality = 0 THEN 'organelle' ELSE 'unknown' END AS kingdom
  FROM documents LEFT JOIN labels USING (doc_id))
SELECT CASE WHEN kingdom = 'bacteria' THEN 'search' WHEN kingdom = 'eukarya' THEN 'skip_eukarya' WHEN density > 0.4 THEN 'search_rescued_coding_density' WHEN kingdom = 'organelle' THEN 'skip_organelle' ELSE 'skip_unknown' END AS decision,
  count(*) AS contigs, CAST(sum(n_chars) AS BIGINT) AS bp FROM k GROUP BY 1""",
    "q15_acceptance_gate": """WITH p AS (SELECT CAST(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS a, CAST(sum(l_quantity) AS BIGINT) AS b, CAST(max(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY l_orderkey)
SELECT CASE WHEN CAST(a AS DOUBLE) / b < 0.5 THEN 'rejected_sequence_loss' WHEN n * 2 > b * 1.25 THEN 'rejected_length_inflation' WHEN n > 30 THEN 'accepted' ELSE 'rejected_no_gain' END AS outcome,
  count(*) AS bins, CAST(sum(b) AS BIGINT) AS bp FROM p GROUP BY 1""",
    "q16_eligibility": """WITH o AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN 'Unclassified' WHEN o_orderpriority LIKE '5%' THEN 'unclassified_' || o_orderstatus ELSE o_orderpriority END AS label FROM orders),
p AS (SELECT label, o_orderstatus, count(*) AS contigs, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM o GROUP BY ALL)
SELECT label, o_orderstatus, contigs, CASE WHEN label LIKE 'unclassified!_%' ESCAPE '!' THEN 'skip_unclassified' WHEN o_orderstatus = 'O' THEN 'skip_domain' WHEN v > 100000000 THEN 'skip_size' ELSE 'eligible' END AS decision
FROM p WHERE label <> 'Unclassified'""",
    "q27_partition_verify": """WITH b AS (SELECT doc_id, 'good' AS bin FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1),
p AS (SELECT doc_id, min(bin) AS part, count(DISTINCT bin) AS n FROM b GROUP BY doc_id)
SELECT coalesce(part, 'Unbinned') AS part, count(*) AS contigs, CAST(sum(n_chars) AS BIGINT) AS bp, CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS overlapping FROM documents LEFT JOIN p USING (doc_id) GROUP BY 1""",
    "q49_dictionary": """WITH f AS (SELECT coalesce(lang, 'NA') AS level, min(doc_id) AS first, count(*) AS n FROM documents GROUP BY 1) SELECT level, n, row_number() OVER (ORDER BY first) - 1 AS code FROM f""",
}
QUERIES = {name: globals()[name] for name in SQL}
