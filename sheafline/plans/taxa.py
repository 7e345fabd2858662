"""Queries on taxonomies, with their SQL: regions, nations and suppliers are a tree of taxa, parts and orders point into it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph, taxonomy
from ..session import table
from .shapes import shape, sql

#: The tree in both dialects: (taxid, parent, rank, name). Suppliers are species, nations genera, regions orders or families.
NODES = [
    ("region", "1000 + r_regionkey", "CASE WHEN r_regionkey = 3 THEN 10239 WHEN r_regionkey = 4 THEN 2759 ELSE 2 END", "CASE WHEN r_regionkey % 2 = 0 THEN 'family' ELSE 'order' END", "r_name"),
    ("nation", "2000 + n_nationkey", "1000 + n_regionkey", "CASE WHEN n_nationkey % 4 = 0 THEN 'no rank' ELSE 'genus' END", "n_name"),
    ("supplier", "100000 + s_suppkey", "2000 + s_nationkey", "'species'", "s_name"),
]
TOP = [(1, 1, "no rank", "root"), (2, 1, "superkingdom", "Bacteria"), (2759, 1, "superkingdom", "Eukaryota"), (10239, 1, "acellular root", "Viruses"), (33208, 2759, "kingdom", "Metazoa")]


def _nodes(spark, d):
    out = spark.createDataFrame(TOP, "taxid long, parent long, rank string, name string")
    for source, taxid, parent, rank, name in NODES:
        up = f"CASE WHEN r_regionkey = 0 THEN 33208 ELSE {parent} END" if source == "region" else parent
        out = out.unionByName(table(spark, d, source).selectExpr(f"CAST({taxid} AS BIGINT) AS taxid", f"CAST({up} AS BIGINT) AS parent", f"{rank} AS rank", f"{name} AS name"))
    return out


def _closure(spark, d):
    return graph.closure(_nodes(spark, d).select(F.col("taxid").alias("node"), "parent"))


def q100_merged_taxa(spark, d):
    """Part keys as old identifiers: chains of up to three links, and circles of two."""
    part = table(spark, d, "part")
    merged = part.select(F.col("p_partkey").alias("old"), F.expr("CASE WHEN p_partkey % 10 = 7 THEN p_partkey + 1 WHEN p_partkey % 10 = 8 THEN p_partkey - 1 ELSE p_partkey + 1 END").alias("new")).where("old % 10 IN (1, 2, 3, 7, 8)")
    return taxonomy.resolve_merged(part.select(F.col("p_partkey").alias("taxid")), merged)


def q101_lineages(spark, d):
    nodes = _nodes(spark, d)
    return taxonomy.lineages(_closure(spark, d), nodes, nodes.select("taxid", "name").where("taxid % 7 <> 0")).select("taxid", "rank", "name")


def q102_anchors(spark, d):
    return taxonomy.anchors(_closure(spark, d), _nodes(spark, d))


def q103_categories(spark, d):
    return taxonomy.categories(_closure(spark, d))


def _votes(spark, d):
    line = table(spark, d, "lineitem")
    hits = line.select(F.col("l_orderkey").alias("gene"), F.floor("l_extendedprice").cast("long").alias("score"), F.when(F.col("l_suppkey") % 13 != 0, F.col("l_suppkey") + 100000).alias("taxid"))
    return taxonomy.gene_votes(hits, _closure(spark, d))


def q104_gene_votes(spark, d):
    return _votes(spark, d)


def q105_contig_consensus(spark, d):
    votes = _votes(spark, d).join(table(spark, d, "orders"), F.col("gene") == F.col("o_orderkey")).select(F.col("o_custkey").alias("contig"), "taxid")
    return taxonomy.contig_consensus(votes, _closure(spark, d))


LINEAGE = "concat(CASE p_size % 4 WHEN 0 THEN 'Bacteria' WHEN 1 THEN ' Eukaryota' WHEN 2 THEN 'Archaea ' ELSE 'Unassigned' END, CASE WHEN p_size % 5 = 0 THEN '; Metazoa' ELSE '; other' END, '; Supplier#', lpad(CAST(p_partkey % 50 AS STRING), 9, '0'), ';', p_partkey)"


def _abundance(spark, d):
    return taxonomy.abundances(table(spark, d, "part").select(F.expr(LINEAGE).alias("lineage"), F.expr("CAST(p_size AS DOUBLE)").alias("count")))


def q106_abundances(spark, d):
    return _abundance(spark, d)


def q107_corroboration(spark, d):
    sup = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    taxa = sup.select((F.col("s_suppkey") + 100000).alias("taxid"), F.explode(F.array("s_name", "n_name")).alias("name"))
    return taxonomy.corroboration(taxa, _abundance(spark, d))


def q108_taxa_fields(spark, d):
    part = table(spark, d, "part")
    field = F.concat_ws("<>", "p_type", F.concat_ws("; ", "p_brand", "p_type"), F.lit(""))
    return part.select("p_partkey", F.array_join(taxonomy.taxa_list(field), "|").alias("taxa"), F.array_join(taxonomy.lineage_tokens(F.concat_ws(";", "p_brand", F.lit(" X "), "p_name")), "|").alias("tokens"))


def q109_taxonomy_index(spark, d):
    """Bins of a stage with their taxon, sizes and quality, unbinned parts left out."""
    return shape(spark, d, "bins").where("NOT lower(trim(coalesce(bin, ''))) IN ('', 'unbinned', 'unclassified')").select("rank", "bin", "contigs", "bp", "completeness")


def q110_parsed_fasta(spark, d):
    """The text of documents as records: strict checks of a record's header and letters."""
    from ..sources import records

    lines = table(spark, d, "documents").select(F.concat(F.lit(">d"), "doc_id", F.lit(" "), "lang", F.lit("\n"), F.regexp_replace("text", "[^A-Za-z\n]", "")).alias("value"))
    return records.parse_fasta(lines).select("id", "header", F.length("seq").cast("long").alias("n"), F.sha2("seq", 256).alias("sha"))


_TREE = " UNION ALL ".join(
    [f"SELECT CAST({a} AS BIGINT) AS taxid, CAST({b} AS BIGINT) AS parent, '{c}' AS rank, '{n}' AS name" for a, b, c, n in TOP]
    + [f"SELECT {t}, {'CASE WHEN r_regionkey = 0 THEN 33208 ELSE ' + p + ' END' if s == 'region' else p}, {r}, {n} FROM {s}" for s, t, p, r, n in NODES]
)
_CLOSURE = f"nodes AS ({_TREE}), tree AS (SELECT taxid AS node, taxid AS ancestor, CAST(0 AS BIGINT) AS distance FROM nodes UNION ALL SELECT tree.node, parent, distance + 1 FROM tree JOIN nodes ON tree.ancestor = taxid WHERE parent <> taxid)"
_RANKED = "CASE rank WHEN 'superkingdom' THEN 'domain' ELSE rank END"
_HEIGHT = "h AS (SELECT node AS ancestor, max(distance) AS depth FROM tree GROUP BY 1)"
_VOTES = f"""{_HEIGHT}, hits AS (SELECT l_orderkey AS gene, CAST(floor(l_extendedprice) AS BIGINT) AS score, CASE WHEN l_suppkey % 13 <> 0 THEN l_suppkey + 100000 END AS taxid FROM lineitem),
near AS (SELECT DISTINCT gene, taxid FROM (SELECT *, max(score) OVER (PARTITION BY gene) AS best FROM hits) WHERE score >= 0.9 * best AND taxid IS NOT NULL), cnt AS (SELECT gene, count(*) AS n FROM near GROUP BY 1),
anc AS (SELECT gene, ancestor, count(*) AS held FROM near JOIN tree ON node = taxid GROUP BY ALL),
votes AS (SELECT gene, ancestor AS taxid FROM anc JOIN cnt USING (gene) JOIN h USING (ancestor) WHERE held >= n QUALIFY row_number() OVER (PARTITION BY gene ORDER BY depth DESC, ancestor) = 1)"""
_ABUND = f"""p AS (SELECT {LINEAGE.replace("STRING", "VARCHAR")} AS lineage, CAST(p_size AS DOUBLE) AS count FROM part), t AS (SELECT *, list_transform(string_split(lineage, ';'), lambda x: lower(trim(x))) AS tokens FROM p),
k AS (SELECT lineage, count, tokens, list_has_any(tokens, ['bacteria','archaea','eukaryota','eukaryotes','eukarya']) AND NOT list_has_any(tokens, ['metazoa','animalia','embryophyta']) AS retained FROM t),
a AS (SELECT lineage, count, tokens, retained, CASE WHEN retained THEN 'retained' ELSE 'animal/land-plant-or-unresolved-lineage' END AS reason,
  CASE WHEN retained THEN CAST(sum(CASE WHEN retained THEN 1 ELSE 0 END) OVER (ORDER BY count DESC, lineage ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS rank_retained,
  round(count / sum(count) OVER (), 8) AS fraction_all, CASE WHEN retained THEN round(count / sum(CASE WHEN retained THEN count END) OVER (), 8) ELSE CAST(0 AS DOUBLE) END AS fraction_retained FROM k)"""

SQL = {
    "q100_merged_taxa": """SELECT p_partkey AS taxid, CASE p_partkey % 10 WHEN 1 THEN p_partkey + 3 WHEN 2 THEN p_partkey + 2 WHEN 3 THEN p_partkey + 1 ELSE p_partkey END AS current FROM part""",
    "q101_lineages": f"""WITH RECURSIVE {_CLOSURE}, r AS (SELECT node, {_RANKED} AS rank, CASE WHEN taxid % 7 <> 0 THEN name ELSE CAST(taxid AS VARCHAR) END AS name, distance FROM tree JOIN nodes ON ancestor = taxid WHERE {_RANKED} IN ('domain','kingdom','phylum','class','order','family','genus','species')),
w AS (SELECT node, rank, arg_min(name, distance) AS name FROM r GROUP BY ALL)
SELECT node AS taxid, rank, name FROM w UNION ALL SELECT node, 'domain', 'Viruses' FROM tree WHERE ancestor = 10239 AND node NOT IN (SELECT node FROM w WHERE rank = 'domain')""",
    "q102_anchors": f"""WITH RECURSIVE {_CLOSURE}, f AS (SELECT node, arg_min(ancestor, (CASE rank WHEN 'genus' THEN 0 WHEN 'family' THEN 1 ELSE 2 END, distance)) AS anchor FROM tree JOIN nodes ON ancestor = taxid WHERE rank IN ('genus','family','order') GROUP BY 1)
SELECT taxid, coalesce(anchor, 0) AS anchor FROM nodes LEFT JOIN f ON node = taxid""",
    "q103_categories": f"""WITH RECURSIVE {_CLOSURE}, c AS (SELECT node AS taxid, min(CASE WHEN ancestor IN (33208, 3193) THEN 0 WHEN ancestor = 2 THEN 1 WHEN ancestor = 2157 THEN 2 WHEN ancestor = 4751 THEN 3 WHEN ancestor = 2759 THEN 4 END) AS k FROM tree GROUP BY 1)
SELECT taxid, CASE k WHEN 0 THEN 'excluded_animal_or_land_plant' WHEN 1 THEN 'Bacteria' WHEN 2 THEN 'Archaea' WHEN 3 THEN 'Fungi' WHEN 4 THEN 'Other_eukaryote_putative_protist' ELSE 'Unknown_or_other' END AS category FROM c""",
    "q104_gene_votes": f"WITH RECURSIVE {_CLOSURE}, {_VOTES} SELECT * FROM votes",
    "q105_contig_consensus": f"""WITH RECURSIVE {_CLOSURE}, {_VOTES}, v AS (SELECT o_custkey AS contig, taxid FROM votes JOIN orders ON gene = o_orderkey), g AS (SELECT contig, count(*) AS genes FROM v GROUP BY 1), s AS (SELECT contig, ancestor, count(*) AS n FROM v JOIN tree ON node = taxid GROUP BY ALL),
best AS (SELECT contig, ancestor, n FROM s JOIN g USING (contig) JOIN h USING (ancestor) WHERE n >= 0.7 * genes QUALIFY row_number() OVER (PARTITION BY contig ORDER BY depth DESC, ancestor) = 1)
SELECT contig, ancestor AS taxid, round(coalesce(CAST(n AS DOUBLE) / genes, 0), 6) AS support, genes FROM g LEFT JOIN best USING (contig)""",
    "q106_abundances": f"WITH {_ABUND} SELECT lineage, count, retained, reason, rank_retained, fraction_all, fraction_retained FROM a",
    "q107_corroboration": f"""WITH {_ABUND}, x AS (SELECT s_suppkey + 100000 AS taxid, lower(unnest([s_name, n_name])) AS token FROM supplier JOIN nation ON s_nationkey = n_nationkey), y AS (SELECT DISTINCT lineage, count, rank_retained, unnest(tokens) AS token FROM a WHERE retained),
m AS (SELECT DISTINCT taxid, lineage, count, rank_retained FROM x JOIN y USING (token)) SELECT s_suppkey + 100000 AS taxid, coalesce(sum(count), 0) AS matched, min(rank_retained) AS best_rank FROM supplier LEFT JOIN m ON taxid = s_suppkey + 100000 GROUP BY 1""",
    "q108_taxa_fields": """SELECT p_partkey, CASE WHEN p_type = p_brand THEN p_type ELSE p_type || '|' || p_brand END AS taxa, lower(trim(p_brand)) || '|x|' || lower(trim(p_name)) AS tokens FROM part""",
    "q109_taxonomy_index": f"WITH {sql('bins')} SELECT rank, bin, contigs, bp, completeness FROM bins WHERE lower(trim(bin)) NOT IN ('', 'unbinned', 'unclassified')",
    "q110_parsed_fasta": """WITH t AS (SELECT doc_id, lang, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS seq FROM documents) SELECT 'd' || doc_id AS id, 'd' || doc_id || ' ' || lang AS header, length(seq) AS n, sha256(seq) AS sha FROM t""",
}
QUERIES = {name: globals()[name] for name in SQL}
