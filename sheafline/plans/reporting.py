"""Queries on filters, joins, searches, pivots and text functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import checks, metrics, select
from ..session import table
from .shapes import crc_sql


def q17_seeded_sample(spark, d):
    return table(spark, d, "documents").where(select.seeded_sample(F.col("doc_id"), 0.25)).select("doc_id", "n_chars")


def q18_semi_anti_union(spark, d):
    orders, cus = table(spark, d, "orders"), table(spark, d, "customer")
    many = orders.groupBy("o_custkey").count().where("count >= 12").select(F.col("o_custkey").alias("c_custkey"))
    big = orders.where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey")).distinct()
    both = cus.join(many, "c_custkey", "left_semi").select("c_custkey", F.lit("many").alias("why")).unionByName(cus.join(big, "c_custkey", "left_anti").select("c_custkey", F.lit("no_big").alias("why")))
    return both


def q19_left_join_defaults(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return docs.join(labels, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).cast("long").alias("quality"), F.when(F.col("toxic").isNull(), "NA").when(F.col("toxic") == 1, "true").otherwise("false").alias("toxic_text"))


def q20_coalesce_fallback(spark, d):
    cus, nation, sup = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "supplier")
    one = sup.groupBy("s_nationkey").agg(F.count("*").alias("n"), F.max("s_name").alias("s_name")).where("n = 1 OR s_nationkey < 5").select("s_nationkey", "s_name")
    j = cus.join(nation, cus["c_nationkey"] == nation["n_nationkey"]).join(one, cus["c_nationkey"] == one["s_nationkey"], "left")
    return j.select("c_custkey", F.coalesce("s_name", "n_name").alias("source_name"), F.when(F.col("s_name").isNull(), "nation").otherwise("supplier").alias("source_kind"))


TYPES = ["click", "error", "purchase", "signup", "view"]


def q21_pivot_matrix(spark, d):
    per = table(spark, d, "events").groupBy("user_id").pivot("event_type", TYPES).agg(F.count("event_id"))
    return per.fillna(0, TYPES).select("user_id", *[F.col(t).cast("long").alias(t) for t in TYPES])


def q22_topk_longest(spark, d):
    return table(spark, d, "documents").orderBy(F.desc("n_chars"), "doc_id").limit(100).select("doc_id", "n_chars", "source")


def q23_paginate_nulls_last(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return docs.orderBy(F.col("quality").asc_nulls_last(), F.desc("n_chars"), "doc_id").offset(100).limit(100).select("doc_id", "quality")


def q24_search_query(spark, d):
    part = table(spark, d, "part")
    return part.where(select.search(["p_name", "p_brand", "p_type"], "Brand#1, steel, -small")).select("p_partkey", "p_name")


def q24b_name_search(spark, d):
    clean = lambda c: F.regexp_replace(F.lower(c), "[_\\s]+", " ")
    return table(spark, d, "part").where(clean(F.col("p_name")).contains("small r")).select("p_partkey", "p_name")


CORNERS = [(-0.2, -0.15), (0.1, -0.2), (0.25, 0.05), (0.0, 0.0), (0.05, 0.2), (-0.15, 0.1)]


def q25_point_in_polygon(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return e.where(select.in_polygon(F.col("x"), F.col("y"), CORNERS)).select("vec_id")


def q26_signed_power_log(spark, d):
    x = F.col("c_acctbal")
    return table(spark, d, "customer").select("c_custkey", F.round(F.signum(x) * F.pow(F.abs(x), F.lit(0.5)), 6).alias("signed_root"), F.round(F.when(x > 0, F.log10(x)), 6).alias("log_value"))


def q33_mate_routing(spark, d):
    talk = table(spark, d, "conversations")
    per = talk.groupBy("conv_id").agg(F.countDistinct("role").alias("roles"), F.max(F.when(F.col("role") == "user", F.length("text"))).alias("u"), F.max(F.when(F.col("role") == "assistant", F.length("text"))).alias("a"))
    out = F.when(F.col("roles") < 2, "unmapped_or_ambiguous").when((F.col("u") % 7) != (F.col("a") % 7), "cross_bin").when(F.col("u") % 7 == 0, "unassigned").otherwise("accepted")
    return per.groupBy(out.alias("routing")).agg(F.count("*").cast("long").alias("n"))


def q39_conditional_rank(spark, d):
    """Rank among the customers that are kept, over the whole table, and each one's share of all."""
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").cast("long").alias("n"))
    kept = F.col("n") >= 10
    ranked = checks.running(orders, [F.desc("n"), F.col("o_custkey")], kept.cast("int"), "rank")
    total = orders.agg(F.sum("n").alias("total"))
    return ranked.join(F.broadcast(total)).select("o_custkey", "n", F.when(kept, F.col("rank")).alias("rank_retained"), F.round(F.col("n") / F.col("total"), 8).alias("fraction_all"))  # one row


def q46_sanitise(spark, d):
    safe = lambda c: F.regexp_replace(c, "[^A-Za-z0-9_.-]", "_")
    return table(spark, d, "part").select("p_partkey", safe(F.concat_ws("#", "p_name", "p_brand")).alias("safe"), select.sanitised(F.concat(F.lit(" "), "p_type", F.lit(" é x "))).alias("label"))


def q47_json_extract(spark, d):
    e = table(spark, d, "events")
    k = F.coalesce(F.get_json_object("props", "$.key"), F.get_json_object("props", "$.k"))
    return e.select("event_id", k.cast("long").alias("k"))


def q48_tolerant_numbers(spark, d):
    word = F.split(F.col("text"), " ")[0]
    raw = F.when(F.col("doc_id") % 4 == 0, F.col("n_chars").cast("string")).when(F.col("doc_id") % 4 == 1, F.lit("NA")).when(F.col("doc_id") % 4 == 2, F.lit("-")).otherwise(F.substring(word, 1, 3))
    return table(spark, d, "documents").select("doc_id", raw.try_cast("double").alias("v"))


def q51_freshness(spark, d):
    docs = table(spark, d, "documents")
    now = docs.select("doc_id", F.sha2("text", 256).alias("digest"))
    moved = F.when(F.col("doc_id") % 5 == 0, -F.col("doc_id") - 1).otherwise(F.col("doc_id"))
    old = docs.select(moved.alias("doc_id"), F.sha2(F.when(F.col("doc_id") % 3 == 0, F.upper("text")).otherwise(F.col("text")), 256).alias("digest"))
    return checks.freshness(now, old, "doc_id").groupBy("source_state").agg(F.count("*").cast("long").alias("n"))


def q52_joint_outliers(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.col("n_chars").cast("double").alias("v"))
    centre = metrics.robust(docs, ["source"], "v")
    far = F.abs(F.col("v") - F.col("med")) > F.greatest(F.col("mad") * 4.4478, F.lit(1500.0))
    return docs.join(centre, "source").groupBy("source").agg(F.sum(far.cast("int")).cast("long").alias("outliers"), F.sum((~far).cast("int")).cast("long").alias("coherent"))


def q53_competitive_assign(spark, d):
    line = table(spark, d, "lineitem").withColumn("p", F.col("l_extendedprice").cast("decimal(18,2)"))
    per = line.groupBy("l_orderkey", "l_returnflag", "l_linestatus").agg(F.max("p").alias("best")).groupBy("l_orderkey", "l_returnflag").agg(F.sum("best").alias("total"))
    top = per.groupBy("l_orderkey").agg(F.max("total").alias("top")).join(per, "l_orderkey").where("total = top")
    return top.groupBy("l_orderkey").agg(F.count("*").alias("k"), F.min("l_returnflag").alias("bin")).where("k = 1").groupBy("bin").agg(F.count("*").cast("long").alias("templates"))


def q54_spaced_selection(spark, d):
    per = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return per.select("l_suppkey", F.explode(select.spaced(F.col("n"), 10)).alias("pick"))


def q55_junction_support(spark, d):
    e = table(spark, d, "events").withColumn("flag", F.get_json_object("props", "$.k").cast("int"))
    used = e.where((F.col("flag").bitwiseAND(4) == 0) & (F.col("value") >= 2))
    per = used.groupBy("user_id").agg(F.count("*").alias("reads"), F.countDistinct(F.hour("ts"), "event_type").alias("starts"))
    status = F.when((F.col("reads") >= 3) & (F.col("starts") >= 2), "junction_read_supported").when(F.col("reads") > 0, "limited_junction_support").otherwise("no_unique_junction_support")
    return per.select("user_id", F.col("reads").cast("long").alias("reads"), F.col("starts").cast("long").alias("starts"), status.alias("status"))


def _polygon_sql():
    out = "false"
    for (ax, ay), (bx, by) in zip(CORNERS, CORNERS[-1:] + CORNERS[:-1], strict=True):
        out = f"({out} <> ((({ay} > y) <> ({by} > y)) AND x < CAST({bx - ax!r} AS DOUBLE) * (y - CAST({ay} AS DOUBLE)) / CAST({by - ay if by != ay else 1.0!r} AS DOUBLE) + CAST({ax} AS DOUBLE)))"
    return out


SQL = {
    "q17_seeded_sample": f"SELECT doc_id, n_chars FROM documents WHERE {crc_sql('CAST(doc_id AS VARCHAR)')} < {int(0.25 * 2**32)}",
    "q18_semi_anti_union": """SELECT c_custkey, 'many' AS why FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 12)
UNION ALL SELECT c_custkey, 'no_big' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)""",
    "q19_left_join_defaults": "SELECT doc_id, CAST(coalesce(quality, -1) AS BIGINT) AS quality, CASE WHEN toxic IS NULL THEN 'NA' WHEN toxic = 1 THEN 'true' ELSE 'false' END AS toxic_text FROM documents LEFT JOIN labels USING (doc_id)",
    "q20_coalesce_fallback": """WITH one AS (SELECT s_nationkey, max(s_name) AS s_name FROM supplier GROUP BY 1 HAVING count(*) = 1 OR s_nationkey < 5)
SELECT c_custkey, coalesce(s_name, n_name) AS source_name, CASE WHEN s_name IS NULL THEN 'nation' ELSE 'supplier' END AS source_kind FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN one ON c_nationkey = s_nationkey""",
    "q21_pivot_matrix": "SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in TYPES) + " FROM events GROUP BY user_id",
    "q22_topk_longest": "SELECT doc_id, n_chars, source FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100",
    "q23_paginate_nulls_last": "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) ORDER BY quality ASC NULLS LAST, n_chars DESC, doc_id LIMIT 100 OFFSET 100",
    "q24_search_query": "WITH p AS (SELECT *, lower(p_name || chr(10) || p_brand || chr(10) || p_type) AS t FROM part) SELECT p_partkey, p_name FROM p WHERE (contains(t, 'brand#1') OR contains(t, 'steel')) AND NOT contains(t, 'small')",
    "q24b_name_search": "SELECT p_partkey, p_name FROM part WHERE contains(regexp_replace(lower(p_name), '[_\\s]+', ' ', 'g'), 'small r')",
    "q25_point_in_polygon": f"WITH e AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings) SELECT vec_id FROM e WHERE {_polygon_sql()}",
    "q26_signed_power_log": "SELECT c_custkey, round(sign(c_acctbal) * pow(abs(c_acctbal), 0.5), 6) AS signed_root, round(CASE WHEN c_acctbal > 0 THEN log10(c_acctbal) END, 6) AS log_value FROM customer",
    "q33_mate_routing": """WITH p AS (SELECT count(DISTINCT role) AS roles, max(CASE WHEN role = 'user' THEN length(text) END) AS u, max(CASE WHEN role = 'assistant' THEN length(text) END) AS a FROM conversations GROUP BY conv_id)
SELECT CASE WHEN roles < 2 THEN 'unmapped_or_ambiguous' WHEN u % 7 <> a % 7 THEN 'cross_bin' WHEN u % 7 = 0 THEN 'unassigned' ELSE 'accepted' END AS routing, count(*) AS n FROM p GROUP BY 1""",
    "q39_conditional_rank": """WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT o_custkey, n, CASE WHEN n >= 10 THEN CAST(sum(CASE WHEN n >= 10 THEN 1 ELSE 0 END) OVER (ORDER BY n DESC, o_custkey ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS rank_retained, round(CAST(n AS DOUBLE) / sum(n) OVER (), 8) AS fraction_all FROM o""",
    "q46_sanitise": """SELECT p_partkey, regexp_replace(p_name || '#' || p_brand, '[^A-Za-z0-9_.-]', '_', 'g') AS safe, trim(regexp_replace(' ' || p_type || ' é x ', '[^\\p{L}\\p{N}._-]', '_', 'g'), '_') AS label FROM part""",
    "q47_json_extract": "SELECT event_id, CAST(coalesce(props->>'$.key', props->>'$.k') AS BIGINT) AS k FROM events",
    "q48_tolerant_numbers": """SELECT doc_id, TRY_CAST(CASE WHEN doc_id % 4 = 0 THEN CAST(n_chars AS VARCHAR) WHEN doc_id % 4 = 1 THEN 'NA' WHEN doc_id % 4 = 2 THEN '-' ELSE substring(split_part(text, ' ', 1), 1, 3) END AS DOUBLE) AS v FROM documents""",
    "q51_freshness": """WITH o AS (SELECT CASE WHEN doc_id % 5 = 0 THEN -doc_id - 1 ELSE doc_id END AS id, sha256(CASE WHEN doc_id % 3 = 0 THEN upper(text) ELSE text END) AS old FROM documents)
SELECT CASE WHEN doc_id IS NULL THEN 'missing_bin' WHEN id IS NULL THEN 'unverified' WHEN old = sha256(text) THEN 'current' ELSE 'stale_input' END AS source_state, count(*) AS n FROM documents FULL JOIN o ON doc_id = id GROUP BY 1""",
    "q52_joint_outliers": """WITH m AS (SELECT source, median(CAST(n_chars AS DOUBLE)) AS m FROM documents GROUP BY 1), v AS (SELECT source, abs(n_chars - m) AS a FROM documents JOIN m USING (source)),
k AS (SELECT source, greatest(median(a) * 4.4478, 1500.0) AS lim FROM v GROUP BY 1)
SELECT source, CAST(sum(CASE WHEN a > lim THEN 1 ELSE 0 END) AS BIGINT) AS outliers, CAST(sum(CASE WHEN a <= lim THEN 1 ELSE 0 END) AS BIGINT) AS coherent FROM v JOIN k USING (source) GROUP BY source""",
    "q53_competitive_assign": """WITH a AS (SELECT l_orderkey, l_returnflag, l_linestatus, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS b FROM lineitem GROUP BY ALL), t AS (SELECT l_orderkey, l_returnflag, sum(b) AS total FROM a GROUP BY ALL),
r AS (SELECT *, max(total) OVER (PARTITION BY l_orderkey) AS top FROM t), u AS (SELECT l_orderkey, min(l_returnflag) AS bin FROM r WHERE total = top GROUP BY 1 HAVING count(*) = 1)
SELECT bin, count(*) AS templates FROM u GROUP BY 1""",
    "q54_spaced_selection": """WITH c AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1),
p AS (SELECT l_suppkey, n, unnest(CASE WHEN n <= 10 THEN range(0, n) ELSE range(0, 10) END) AS i FROM c)
SELECT l_suppkey, CASE WHEN n <= 10 THEN i + 1 ELSE 1 + CAST(round_even(i * (n - 1) / 9.0, 0) AS BIGINT) END AS pick FROM p""",
    "q55_junction_support": """WITH e AS (SELECT *, CAST(props->>'$.k' AS INTEGER) AS flag FROM events),
p AS (SELECT user_id, count(*) AS reads, count(DISTINCT (hour(ts), event_type)) AS starts FROM e WHERE flag & 4 = 0 AND value >= 2 GROUP BY 1)
SELECT user_id, reads, starts, CASE WHEN reads >= 3 AND starts >= 2 THEN 'junction_read_supported' WHEN reads > 0 THEN 'limited_junction_support' ELSE 'no_unique_junction_support' END AS status FROM p""",
}
QUERIES = {name: globals()[name] for name in SQL}
