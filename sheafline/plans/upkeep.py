"""Queries on reconciliation, overrides, logs, numbering and roll-ups, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, metrics
from ..session import table


def q60_latest_record(spark, d):
    return checks.latest(table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


def q61_reconcile(spark, d):
    moved = F.when(F.col("doc_id") % 7 == 0, -F.col("doc_id") - 1).otherwise(F.col("doc_id"))
    docs, labels = table(spark, d, "documents").select(moved.alias("doc_id")), table(spark, d, "labels")
    return checks.reconcile(docs, labels, "doc_id").groupBy("place").agg(F.count("*").cast("long").alias("n"))


def q62_metadata_override(spark, d):
    sup = table(spark, d, "supplier").select("s_suppkey", (F.col("s_nationkey") % 3).alias("level"), "s_nationkey")
    nation = table(spark, d, "nation")
    given = nation.where("n_nationkey < 15").select(F.col("n_nationkey").alias("s_nationkey"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey") % 3).alias("level"), F.col("n_name").alias("code"))
    return checks.override(sup, given, "s_nationkey", "level", "code").select("s_suppkey", "code")


def q63_or_join(spark, d):
    """Order lines of suppliers of a nation or of parts of a brand: two semi-joins, each row once."""
    line = table(spark, d, "lineitem")
    sup = table(spark, d, "supplier").where("s_nationkey = 3").select("s_suppkey")
    part = table(spark, d, "part").where("p_brand = 'Brand#2'").select("p_partkey")
    a = line.join(sup.withColumn("_s", F.lit(True)), F.col("l_suppkey") == F.col("s_suppkey"), "left").join(part.withColumn("_p", F.lit(True)), F.col("l_partkey") == F.col("p_partkey"), "left")
    return a.where("_s OR _p").groupBy("l_returnflag").agg(F.count("*").cast("long").alias("n"), F.sum("l_quantity").cast("long").alias("q"))


def q64_same_sets(spark, d):
    e = table(spark, d, "events").select("event_type", (F.col("user_id") % 40).alias("u"))
    return checks.same_sets(e, "event_type", "u")


def q65_stride_windows(spark, d):
    return metrics.strided(table(spark, d, "documents"), "doc_id", 25, "n_chars").withColumnRenamed("mean", "mean_len")


def q66_dashboard(spark, d):
    got = metrics.tiles(table(spark, d, "documents"), ["lang"], "source", "n_chars")
    return got.select("lang", F.col("samples").alias("sources"), "bins", "bp", F.col("median_size").alias("median_len"))


def q67_provenance(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    kind = F.when(F.col("quality").isNull(), "original").when(F.col("quality") == 1, "accepted").otherwise("rejected")
    return docs.groupBy("source", kind.alias("kind")).agg(F.count("*").cast("long").alias("n"))


def q68_audit_estimate(spark, d):
    o = table(spark, d, "orders").withColumn("audited", F.col("o_orderkey") % 10 == 0)
    lost = F.col("audited") & (F.col("o_orderstatus") == "P")
    per = o.groupBy("o_orderpriority").agg(F.sum(F.when(lost, 1).otherwise(0)).alias("lost"), F.sum(F.when(F.col("audited"), 1).otherwise(0)).alias("seen"), F.count("*").alias("n"))
    return per.select("o_orderpriority", F.round(F.when(F.col("seen") > 0, F.col("lost") / F.col("seen") * F.col("n")), 4).alias("estimate"))


def q69_top_per_group(spark, d):
    per = table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v"))
    return checks.top_each(per, ["l_suppkey"], [F.desc("v"), F.col("l_partkey")], 4).select("l_suppkey", "l_partkey", "k")


def q70_sequential_ids(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    return checks.numbered(docs, ["doc_id"], "c", 7).select("doc_id", "new_id")


def q71_depth_profile(spark, d):
    e = table(spark, d, "events").groupBy("user_id", (F.floor(F.hour("ts") * 60 + F.minute("ts")) % 60).alias("pos")).agg(F.count("*").alias("depth"))
    return checks.median_with_zeros(e, "user_id", "depth", 60)


def q72_complete_groups(spark, d):
    """Length-weighted mean only where every member has a value."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").withColumn("g", F.col("doc_id") % 97)
    return metrics.weighted_if_complete(docs, ["g"], "quality", "n_chars")


SQL = {
    "q60_latest_record": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
    "q61_reconcile": """SELECT CASE WHEN a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL THEN 'both' WHEN a.doc_id IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS place, count(*) AS n
FROM (SELECT DISTINCT CASE WHEN doc_id % 7 = 0 THEN -doc_id - 1 ELSE doc_id END AS doc_id FROM documents) a FULL JOIN (SELECT DISTINCT doc_id FROM labels) b ON a.doc_id = b.doc_id GROUP BY 1""",
    "q62_metadata_override": """WITH g AS (SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey % 3 END AS level, n_name AS code FROM nation WHERE n_nationkey < 15)
SELECT s_suppkey, coalesce(x.code, y.code) AS code FROM supplier LEFT JOIN g x ON x.n_nationkey = s_nationkey AND x.level = s_nationkey % 3 LEFT JOIN g y ON y.n_nationkey = s_nationkey AND y.level IS NULL""",
    "q63_or_join": """SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3)
OR l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#2') GROUP BY 1""",
    "q64_same_sets": """WITH s AS (SELECT event_type, list_sort(list(DISTINCT user_id % 40)) AS l FROM events GROUP BY 1), f AS (SELECT l AS first FROM s ORDER BY event_type LIMIT 1)
SELECT event_type, CAST(len(l) AS BIGINT) AS n, l = first AS same FROM s, f""",
    "q65_stride_windows": "SELECT doc_id // 25 AS stride, round(avg(n_chars), 4) AS mean_len, count(*) AS n FROM documents GROUP BY 1",
    "q66_dashboard": "SELECT lang, count(DISTINCT source) AS sources, count(*) AS bins, CAST(sum(n_chars) AS BIGINT) AS bp, CAST(median(n_chars) AS DOUBLE) AS median_len FROM documents GROUP BY 1",
    "q67_provenance": "SELECT source, CASE WHEN quality IS NULL THEN 'original' WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END AS kind, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL",
    "q68_audit_estimate": """WITH p AS (SELECT o_orderpriority, count(*) FILTER (o_orderkey % 10 = 0 AND o_orderstatus = 'P') AS lost, count(*) FILTER (o_orderkey % 10 = 0) AS seen, count(*) AS n FROM orders GROUP BY 1)
SELECT o_orderpriority, round(CASE WHEN seen > 0 THEN CAST(lost AS DOUBLE) / seen * n END, 4) AS estimate FROM p""",
    "q69_top_per_group": """WITH p AS (SELECT l_suppkey, l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY v DESC, l_partkey) AS k FROM p) SELECT l_suppkey, l_partkey, k FROM r WHERE k <= 4""",
    "q70_sequential_ids": "SELECT doc_id, 'c' || lpad(CAST(row_number() OVER (ORDER BY doc_id) AS VARCHAR), 7, '0') AS new_id FROM documents",
    "q71_depth_profile": """WITH e AS (SELECT user_id, minute(ts) AS pos, count(*) AS depth FROM events GROUP BY ALL), z AS (SELECT u.user_id, coalesce(depth, 0) AS x FROM (SELECT DISTINCT user_id, p FROM events, range(60) t(p)) u
LEFT JOIN e ON e.user_id = u.user_id AND e.pos = u.p)
SELECT user_id, round(avg(x), 6) AS mean_depth, CAST(median(x) AS DOUBLE) AS median_depth, round(count(*) FILTER (x > 0) / 60.0::DOUBLE, 6) AS breadth, round(stddev_pop(x) / avg(x), 4) AS cv FROM z GROUP BY user_id""",
    "q72_complete_groups": """SELECT doc_id % 97 AS g, round(CASE WHEN count(*) = count(quality) THEN CAST(sum(quality * n_chars) AS DOUBLE) / sum(n_chars) END, 6) AS weighted, count(quality) AS known FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""",
}
QUERIES = {name: globals()[name] for name in SQL}
