"""Queries on report tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequences
from ..operators import binning, recruit, report
from ..session import table
from . import bins
from .biology import COMPONENTS, _evidence
from .networks import _SEQ, _sequences
from .shapes import shape, sql


def q210_feature_table(spark, d):
    c = shape(spark, d, "contigs")
    cov = c.where("depth IS NOT NULL").select("contig", F.col("depth").alias("mean_depth"), F.least(F.lit(1.0), F.col("depth") / 16).alias("covered_fraction"))
    out = c.where("kingdom <> 'Unclassified'").select("contig")
    extra = c.where("contig % 3 = 0").select("contig", (F.col("gc") * 2 - 1).alias("pc1"))
    return report.feature_table(c.select("contig", "length", "gc", "domain", "genus", F.col("genus").alias("bin")), {"domain": F.col("domain"), "genus": F.col("genus")}, cov, binning.coding(shape(spark, d, "orfs")), out, extra)


def q211_provenance(spark, d):
    o = shape(spark, d, "originals")
    final = o.select(F.concat(F.lit("f"), "contig").alias("contig"), F.when(F.col("contig") % 3 == 0, "reassembled").otherwise("original").alias("source_type"), F.col("contig").alias("source_record"))
    return report.provenance(final, o.select("contig", F.col("length").alias("source_length"), "domain"))


def q212_split_bins(spark, d):
    line = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_partkey", "l_suppkey", F.floor("l_extendedprice").cast("long").alias("price"))
    cut = table(spark, d, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("split_"), "o_orderstatus").alias("label"))
    got = report.split_bins(cut, line, ["l_linenumber", "l_partkey", "l_suppkey", "price"])
    return got.groupBy("label").agg(F.count("*").cast("long").alias("n"), F.sum("l_partkey").cast("long").alias("parts"))


def q213_missing_components(spark, d):
    panel = spark.createDataFrame([("p1", c) for c, _ in COMPONENTS[:3]] + [("p2", c) for c, _ in COMPONENTS[2:]], "pathway string, component string")
    return report.missing_components(_evidence(spark, d), panel)


def q214_rule_models(spark, d):
    m = shape(spark, d, "models")
    rules = m.select("model", F.array("component", F.concat(F.lit("k"), F.col("model") % 4)).alias("components"))
    definitions = m.select(F.concat(F.lit("p"), F.col("model") % 3).alias("pathway"), F.concat(F.lit("k"), F.col("model") % 9).alias("component")).distinct()
    return report.rule_models(definitions, rules.withColumn("components", F.array_distinct("components")))


def q215_updated(spark, d):
    b = shape(spark, d, "bins").select("bin", "completeness", "contamination")
    values = shape(spark, d, "bins").where("contigs % 2 = 0").select("bin", F.col("contigs").cast("double").alias("completeness"))
    return report.updated(b, values.where("completeness > 4"), "bin", ["completeness"])


def _alignment(spark, d):
    """Sequences cut to one length, with gaps, as an alignment of each source."""
    s = _sequences(spark, d).join(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source"), "id").where(F.length("seq") >= 60)
    gap = F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.when((F.col("id") + i * i) % (2 + i % 5) == 0, F.lit("-")).otherwise(F.expr("substring(seq, 1, 1)")))
    return s.select("source", "id", F.array_join(gap, "").alias("seq"))


def q216_occupancy(spark, d):
    return report.occupancy(_alignment(spark, d), "source", 0.75)


def q217_trimmed(spark, d):
    return report.trimmed(_alignment(spark, d), "source", 0.75).select("source", "id", F.length("seq").cast("long").alias("n"), F.sha2("seq", 256).alias("sha"))


def q218_markers(spark, d):
    members = table(spark, d, "lineitem").select(F.col("l_partkey").alias("marker"), F.concat(F.lit("n"), F.col("l_suppkey") % 8).alias("genome"))
    return report.markers(members, 8, "n3")


def q219_shown_bins(spark, d):
    counts = _evidence(spark, d).select(F.concat_ws("/", F.col("bin").cast("string"), "component").alias("pair"), "component", F.coalesce("copies", F.lit(0)).alias("copies"), "bin").withColumn("group", F.col("bin") % 60)
    return report.shown_bins(counts.where("component = 'purchase' OR component = 'signup'"), "bin", "copies").select("bin", "component", "copies")


def q220_legend(spark, d):
    return report.legend(table(spark, d, "part").withColumn("label", F.concat_ws(" ", "p_brand", "p_type")), "label", 14)


def q221_sorted_values(spark, d):
    """A column of numbers, texts and gaps in the order of a report's table, as places."""
    from ..operators.checks import running

    v = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.col("p_size").cast("string")).when(F.col("p_partkey") % 3 == 1, F.col("p_name")).alias("v"))
    keyed = v.select("*", *[k.alias(f"k{i}") for i, k in enumerate(report.sort_key(F.col("v")))])
    return running(keyed, ["k0", "k1", "k2", "k3", "k4", "p_partkey"], F.lit(1), "place").select("p_partkey", "place")


def q222_numeric_columns(spark, d):
    docs = table(spark, d, "documents").select(F.col("n_chars").cast("string").alias("a"), F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")).otherwise("x").alias("b"), "lang", F.when(F.col("doc_id") % 5 == 0, F.lit("1.5")).alias("c"))
    return report.numeric_columns(docs, ["a", "b", "lang", "c"])


def q223_digests(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", report.digest(F.col("s_suppkey"), F.col("s_name"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).alias("nation")).alias("digest"))


def q224_radii(spark, d):
    line = table(spark, d, "lineitem").select("l_suppkey", (F.floor("l_quantity") / 64).alias("distance"))
    return report.radii(line, "l_suppkey", "distance")


def q225_frontier(spark, d):
    s = _sequences(spark, d)
    reads = s.select("id", F.expr("substring(seq, 1, 400)").alias("seq"))
    baits = s.select((F.col("id") + 1).alias("id"), F.expr("right(seq, 60)").alias("seq")).where("id % 4 = 0 OR id % 4 = 1")
    return report.frontier(reads, baits, 9, 2)


def q226_invalid_rules(spark, d):
    m = shape(spark, d, "models")
    rules = m.select(F.col("accession").alias("model"), F.array("component", F.concat(F.lit("k"), F.col("model") % 9)).alias("components"))
    pathways = m.select(F.col("target").alias("pathway"), F.array(F.concat(F.lit("k"), F.col("model") % 8)).alias("components")).distinct()
    return report.invalid_rules(rules.unionByName(rules.where("model = 'M5'")), m.select("component"), pathways)


def q227_plain_bins(spark, d):
    """Bins straight from the calls of a rank, without unclassified contigs."""
    return bins._calls(spark, d).where("rank = 'genus' AND taxon <> 'Unclassified'").join(shape(spark, d, "contigs").select("contig", "length"), "contig").groupBy(F.col("taxon").alias("bin")).agg(F.count("*").cast("long").alias("contigs"), F.sum("length").cast("long").alias("bp"), F.round(F.min("support"), 6).alias("least_support"))


def q228_catalogue_errors(spark, d):
    """Links and contig places whose node is not in the graph."""
    nodes = table(spark, d, "part").where("p_size > 2").select(F.col("p_partkey").alias("node"))
    links = table(spark, d, "lineitem").select(F.col("l_partkey").alias("node"), F.lit("link").alias("kind"))
    places = table(spark, d, "orders").select((F.col("o_orderkey") % 3000).alias("node"), F.lit("place").alias("kind"))
    return links.unionByName(places).join(nodes, "node", "left_anti").groupBy("kind").agg(F.countDistinct("node").cast("long").alias("nodes"), F.count("*").cast("long").alias("rows"))


def q229_status_counts(spark, d):
    """Tasks by their last status."""
    from ..operators import checks

    last = checks.latest(table(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id"], ["ts", "event_id"])
    return last.groupBy(F.col("event_type").alias("status")).agg(F.count("*").cast("long").alias("tasks"))


def q230_human_sizes(spark, d):
    return table(spark, d, "customer").select("c_custkey", sequences.human_bp(F.floor("c_acctbal").cast("long") * (F.col("c_custkey") % 7) * 64 + 4096).alias("shown"))


def q231_coverage_classes(spark, d):
    return report.coverage_classes(shape(spark, d, "contigs"), "genus", "depth")


def q232_reference_ids(spark, d):
    """Names of the sequences of a reference of all bins, with the bin in them."""
    from ..operators import checks

    m = bins._members(spark, d).where("bin LIKE 'g%'")
    named = checks.numbered(m, ["bin", "contig"], "", 7)
    return named.select("contig", F.concat_ws("_", F.lit("MHSEED"), "bin", "new_id").alias("name"))


def q233_group_clusters(spark, d):
    """Vectors of every third label together, split by k-means where that gives good silhouettes."""
    e = table(spark, d, "embeddings").where("embedding IS NOT NULL").select("vec_id", (F.col("label") % 3).alias("group"), F.col("embedding").cast("array<double>").alias("x"))
    return recruit.seeded_clusters(e, "group", "vec_id", most=3, good=0.1).select("vec_id", "group", "cluster")


def q234_tree_nodes(spark, d):
    """Nodes of a tree in Newick form, written from the regions and nations and parsed again."""
    from ..operators import trees

    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list(F.concat("n_name", F.lit(":"), F.col("n_nationkey") % 4))), ","), F.lit(")'"), F.col("r_name"), F.lit("':2")).alias("t"))
    text = rows.agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list("t")), ","), F.lit(")root;")).alias("text")).select(F.lit(1).alias("tree"), "text")  # a row for each region
    n = trees.nodes(text, "tree", "text")
    return n.join(n.select(F.col("node").alias("parent"), F.col("label").alias("up")), "parent", "left").select(F.col("label").alias("node"), F.col("up").alias("parent"), "length")


_ALIGN = f"""{_SEQ}, al AS (SELECT source, id, array_to_string(list_transform(range(1, 61), lambda i: CASE WHEN (id + i * i) % (2 + i % 5) = 0 THEN '-' ELSE substring(seq, 1, 1) END), '') AS seq FROM seqs JOIN documents ON id = doc_id WHERE length(seq) >= 60),
cells AS (SELECT source, id, p - 1 AS position, substring(seq, p, 1) AS letter FROM (SELECT source, id, seq, unnest(range(1, 61)) AS p FROM al)), mem AS (SELECT source, count(*) AS m FROM al GROUP BY 1),
occ AS (SELECT c.source, position, count(*) AS held, any_value(m) AS m FROM cells c JOIN mem ON mem.source IS NOT DISTINCT FROM c.source WHERE letter <> '-' GROUP BY ALL HAVING count(*) >= ceil(0.75 * any_value(m)))"""
_LINKS = "m AS (SELECT *, model % 4 AS q FROM models)"

SQL = {
    "q210_feature_table": f"""WITH {bins._PRE} SELECT contig AS "ID", length, printf('%.2f', gc * 100) AS "GC", coalesce(printf('%.4f', depth), '') AS coverage, coalesce(printf('%.4f', CASE WHEN depth IS NOT NULL THEN least(1.0, depth / 16) END), '') AS covered_fraction,
  CASE WHEN coding_bp IS NULL THEN 'NA' ELSE printf('%.4f', round_even(density, 4)) END AS coding_density, CASE WHEN coding_bp IS NULL THEN 'NA' ELSE CAST(orfs AS VARCHAR) END AS n_cds, domain AS taxon_domain, genus AS taxon_genus, CASE WHEN kingdom <> 'Unclassified' THEN 'excluded' ELSE genus END AS bin,
  CASE WHEN kingdom <> 'Unclassified' THEN 'false' ELSE 'true' END AS retained, CASE WHEN contig % 3 = 0 THEN printf('%.6f', gc * 2 - 1) ELSE '' END AS pc1 FROM pre""",
    "q211_provenance": f"WITH {sql('originals')} SELECT 'f' || contig AS contig, CASE WHEN contig % 3 = 0 THEN 'reassembled' ELSE 'original' END AS source_type, CASE WHEN contig % 3 <> 0 THEN contig END AS source_record, CASE WHEN contig % 3 <> 0 THEN length END AS source_length, CASE WHEN contig % 3 <> 0 THEN domain END AS domain FROM originals",
    "q212_split_bins": """WITH f AS (SELECT l_orderkey, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(floor(l_extendedprice) AS BIGINT)) = 1)
SELECT 'split_' || o_orderstatus AS label, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS parts FROM f JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F' GROUP BY 1""",
    "q213_missing_components": None,
    "q214_rule_models": f"""WITH {sql("models")}, r AS (SELECT DISTINCT model, unnest([component, 'k' || model % 4]) AS component FROM models), f AS (SELECT DISTINCT 'p' || model % 3 AS pathway, 'k' || model % 9 AS component FROM models) SELECT pathway, f.component, model FROM f LEFT JOIN r ON r.component = f.component""",
    "q215_updated": f"WITH {sql('bins')} SELECT bin, CASE WHEN contigs % 2 = 0 AND contigs > 4 THEN CAST(contigs AS DOUBLE) ELSE completeness END AS completeness, contamination FROM bins",
    "q216_occupancy": f"WITH {_ALIGN} SELECT source, position, round(CAST(held AS DOUBLE) / m, 6) AS share FROM occ WHERE source IS NOT NULL",
    "q217_trimmed": f"WITH {_ALIGN}, t AS (SELECT c.source, c.id, string_agg(letter, '' ORDER BY c.position) AS seq FROM cells c JOIN occ ON occ.source = c.source AND occ.position = c.position GROUP BY ALL) SELECT source, id, length(seq) AS n, sha256(seq) AS sha FROM t",
    "q218_markers": "WITH p AS (SELECT l_partkey AS marker, count(DISTINCT l_suppkey % 8) AS members, max(CASE WHEN l_suppkey % 8 = 3 THEN 1 ELSE 0 END) AS a FROM lineitem GROUP BY 1) SELECT marker, members FROM p WHERE members >= 7 AND a = 1",
    "q219_shown_bins": None,
    "q220_legend": """WITH p AS (SELECT p_brand || ' ' || p_type AS label, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, label) AS k FROM p) SELECT CASE WHEN k <= 14 THEN label ELSE 'other' END AS label, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1""",
    "q221_sorted_values": """WITH v AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) WHEN p_partkey % 3 = 1 THEN p_name END AS v FROM part)
SELECT p_partkey, row_number() OVER (ORDER BY coalesce(v IS NULL OR v = '', true), TRY_CAST(v AS DOUBLE) IS NULL, TRY_CAST(v AS DOUBLE) NULLS FIRST, lower(v) NULLS FIRST, v NULLS FIRST, p_partkey) AS place FROM v""",
    "q222_numeric_columns": """WITH n AS (SELECT count(*) AS n, count(CASE WHEN doc_id % 2 = 0 THEN 1 END) AS b, count(CASE WHEN doc_id % 5 = 0 THEN 1 END) AS c FROM documents), l AS (SELECT 'a' AS "column", n AS rows, n AS numbers FROM n UNION ALL SELECT 'b', n, b FROM n UNION ALL SELECT 'lang', n, 0 FROM n UNION ALL SELECT 'c', n, c FROM n)
SELECT "column", rows, numbers, numbers >= greatest(1.0, 0.5 * rows) AS numeric FROM l""",
    "q223_digests": """SELECT s_suppkey, sha256('{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","nation":' || CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) ELSE 'null' END || '}') AS digest FROM supplier""",
    "q224_radii": "SELECT l_suppkey, round(greatest(0.75, quantile_cont(floor(l_quantity) / 64, 0.95) * 1.5), 6) AS radius FROM lineitem GROUP BY 1",
    "q225_frontier": None,
    "q226_invalid_rules": f"""WITH {sql("models")}, k AS (SELECT DISTINCT component FROM models), a AS (SELECT accession AS name, 'rule' AS kind, unnest([component, 'k' || model % 9]) AS component FROM models UNION SELECT target, 'pathway', 'k' || model % 8 FROM models)
SELECT DISTINCT name, kind, 'unknown component ' || component AS problem FROM a WHERE component NOT IN (SELECT component FROM k) UNION ALL SELECT 'M5', 'rule', 'given twice' FROM models WHERE accession = 'M5'""",
    "q227_plain_bins": f"WITH {sql('contigs')} SELECT genus AS bin, count(*) AS contigs, CAST(sum(length) AS BIGINT) AS bp, round(min(support + 2), 6) AS least_support FROM contigs WHERE genus <> 'Unclassified' GROUP BY 1",
    "q228_catalogue_errors": """WITH n AS (SELECT p_partkey FROM part WHERE p_size > 2), a AS (SELECT l_partkey AS node, 'link' AS kind FROM lineitem UNION ALL SELECT o_orderkey % 3000, 'place' FROM orders) SELECT kind, count(DISTINCT node) AS nodes, count(*) AS rows FROM a WHERE node NOT IN (SELECT p_partkey FROM n) GROUP BY 1""",
    "q229_status_counts": "WITH l AS (SELECT event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) SELECT event_type AS status, count(*) AS tasks FROM l GROUP BY 1",
    "q230_human_sizes": """WITH v AS (SELECT c_custkey, CAST(floor(c_acctbal) AS BIGINT) * (c_custkey % 7) * 64 + 4096 AS n FROM customer) SELECT c_custkey, CASE WHEN n >= 1000000 THEN printf('%.2f Mb', n / 1e6) WHEN n >= 1000 THEN printf('%.1f kb', n / 1e3) ELSE printf('%d bp', n) END AS shown FROM v""",
    "q231_coverage_classes": f"WITH {sql('contigs')} SELECT genus, count(*) FILTER (coalesce(depth, 0) = 0) AS hidden, median(CASE WHEN depth > 0 THEN depth END) AS median FROM contigs GROUP BY 1",
    "q232_reference_ids": f"WITH {bins._M} SELECT contig, 'MHSEED_' || bin || '_' || lpad(CAST(row_number() OVER (ORDER BY bin, contig) AS VARCHAR), 7, '0') AS name FROM members WHERE bin LIKE 'g%'",
    "q234_tree_nodes": """SELECT n_name AS node, r_name AS parent, CAST(n_nationkey % 4 AS DOUBLE) AS length FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'root', 2.0 FROM region UNION ALL SELECT 'root', NULL, NULL""",
}


def _late_sql():
    from .biology import _STATE
    from .networks import _RC

    SQL["q213_missing_components"] = f"WITH {_STATE}, pn(pathway, component) AS (VALUES ('p1','click'),('p1','error'),('p1','purchase'),('p2','purchase'),('p2','signup'),('p2','view')) SELECT bin, pathway, component FROM ev JOIN pn USING (component) WHERE value = 0"
    SQL["q219_shown_bins"] = f"WITH {_STATE}, c AS (SELECT bin, component, coalesce(copies, 0) AS copies FROM ev WHERE component IN ('purchase','signup')) SELECT bin, component, copies FROM c WHERE bin IN (SELECT bin FROM c WHERE copies > 0)"
    SQL["q225_frontier"] = f"""WITH {_SEQ}, rd AS (SELECT id, substring(seq, 1, 400) AS s FROM seqs), bt AS (SELECT right(seq, 60) AS s FROM seqs WHERE (id + 1) % 4 IN (0, 1)), b2 AS (SELECT s FROM bt UNION ALL SELECT {_RC.format("s")} FROM bt),
kb AS (SELECT DISTINCT substring(s, i, 9) AS g FROM (SELECT s, unnest(range(1, length(s) - 7)) AS i FROM b2 WHERE length(s) >= 9)), kr AS (SELECT DISTINCT id, substring(s, i, 9) AS g FROM (SELECT id, s, unnest(range(1, length(s) - 7)) AS i FROM rd WHERE length(s) >= 9))
SELECT id, count(*) AS shared FROM kr WHERE NOT contains(g, 'N') AND g IN (SELECT g FROM kb WHERE NOT contains(g, 'N')) GROUP BY 1 HAVING count(*) >= 2"""


_late_sql()
QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q2")}
