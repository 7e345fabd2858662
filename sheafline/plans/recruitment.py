"""Queries on recruitment by distance, seeded clusters, and components of graphs, with their SQL: vectors are contigs, runs of fifty of a label are bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph, recruit, select
from ..session import table, written

#: A centre's radius and taxon, a row's taxon and length; every expression means the same in Spark and in DuckDB.
BIN, RADIUS, BIN_TAXON, HELD = "label * 1000 + CAST(floor(vec_id / 50) AS INT)", "960 + 20 * (bin % 7)", "200 + CAST(floor(bin / 1000) AS INT)", "1000 * (bin % 3)"
TAXON = "CASE vec_id % 5 WHEN 1 THEN 200 + label WHEN 2 THEN 100 + label % 5 WHEN 3 THEN 2 WHEN 4 THEN 1 END"
LENGTH = "600 + vec_id % 400"
CAP, RATIO, DOMAINS = 4000, 0.75, [2]


def _rows(spark, d):
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024).cast("long")).alias("v")
    return table(spark, d, "embeddings").where("label IS NOT NULL AND embedding IS NOT NULL").selectExpr("*", f"{BIN} AS bin", f"{TAXON} AS taxon", f"{LENGTH} AS length").select("vec_id", "label", "bin", "taxon", "length", v)


def _centres(rows):
    return written(select.centroids(rows, "bin", "v").selectExpr("bin", "centre", f"{RADIUS} AS radius", f"{BIN_TAXON} AS bin_taxon"), "centres")


def _taxa(rows):
    """Species, of rows and of centres, under genera under a domain under the root."""
    labels = rows.select("label").unionByName(rows.selectExpr(f"{BIN_TAXON} - 200 AS label")).distinct()
    species = labels.selectExpr("200 + label AS node", "100 + label % 5 AS parent")
    return species.unionByName(labels.selectExpr("100 + label % 5 AS node", "2 AS parent").distinct()).unionByName(rows.sparkSession.sql("SELECT 2 AS node, 1 AS parent UNION ALL SELECT 1, CAST(NULL AS INT)"))


def q41_centroid_ratio(spark, d):
    """The nearest centre in reach of each vector, and whether the next one in reach is farther by the ratio."""
    rows = _rows(spark, d)
    near = recruit.nearest(rows, "vec_id", "v", _centres(rows), "bin")
    return near.select("vec_id", F.col("bin").alias("nearest"), F.round("distance", 6).alias("distance"), "reached", F.coalesce(F.col("distance") <= RATIO * F.col("next"), F.lit(True)).alias("clear"))


def q240_components(spark, d):
    """Customers tied to an earlier one by their balance: chains and a hub."""
    return graph.components(_ties(spark, d))


TIE = "CASE WHEN c_nationkey = 3 THEN 1 WHEN CAST(floor(abs(c_acctbal)) AS BIGINT) % 3 = 0 THEN c_custkey ELSE greatest(1, c_custkey - 1 - c_custkey % 5) END"


def _ties(spark, d):
    return table(spark, d, "customer").selectExpr("c_custkey AS u", f"{TIE} AS v")


def q241_layers(spark, d):
    """Steps from the customers of one nation over the same ties."""
    seeds = table(spark, d, "customer").where("c_nationkey = 7").selectExpr("c_custkey AS node")
    return graph.layers(_ties(spark, d), seeds)


def q242_proposals(spark, d):
    """The nearest centre in reach whose taxon agrees, unless the next is nearly as near."""
    rows = _rows(spark, d)
    found = recruit.proposals(rows, "vec_id", "v", "taxon", _centres(rows), "bin", "bin_taxon", graph.closure(_taxa(rows)), DOMAINS, RATIO)
    return found.select("vec_id", "bin", F.round("distance", 6).alias("distance"))


def q243_recruited(spark, d):
    """The same, accepted nearest first while the bin stays under its cap."""
    rows = _rows(spark, d)
    centres = _centres(rows)
    found = recruit.proposals(rows, "vec_id", "v", "taxon", centres, "bin", "bin_taxon", graph.closure(_taxa(rows)), DOMAINS, RATIO)
    held = centres.selectExpr("bin", f"CAST({HELD} AS BIGINT) AS size")
    return recruit.recruited(rows, found, "vec_id", "bin", "length", held, CAP).select("vec_id", "bin", F.round("distance", 6).alias("distance"), "taken")


def q244_seeded_clusters(spark, d):
    """Vectors of each label split by k-means; two components weigh as much as all the others together."""
    e = table(spark, d, "embeddings").where("label IS NOT NULL AND embedding IS NOT NULL")
    size = e.select(F.size("embedding").alias("n")).limit(1).collect()
    n = size[0]["n"] if size else 3
    rows = recruit.standardised(e.select("vec_id", "label", "embedding"), [F.get("embedding", F.lit(i)) for i in range(n)], [1, 1, n - 2])
    return recruit.seeded_clusters(rows, "label", "vec_id", good=0.0).select("vec_id", "label", "cluster")


_NEAR = f"""e AS (SELECT vec_id, label, {BIN} AS bin, {TAXON} AS taxon, {LENGTH} AS length, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT bin, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e), c AS (SELECT bin, i, CAST(floor(avg(x)) AS BIGINT) AS x FROM u GROUP BY ALL), cs AS (SELECT bin, list(x ORDER BY i) AS centre, {RADIUS} AS radius, {BIN_TAXON} AS bt FROM c GROUP BY bin),
m AS (SELECT vec_id, taxon, length, cs.bin, bt, radius, sqrt(CAST(list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - centre[i]) * (v[i] - centre[i]))) AS DOUBLE)) AS distance FROM e CROSS JOIN cs), near AS (SELECT * FROM m WHERE distance <= radius)"""
_AGREE = """taxon IS NULL OR taxon = bt OR taxon = 2 OR (taxon BETWEEN 100 AND 199 AND taxon = 100 + (bt - 200) % 5)"""
_PROPOSED = f"""{_NEAR}, k AS (SELECT *, row_number() OVER w AS p, lead(distance) OVER w AS nx FROM near WHERE {_AGREE} WINDOW w AS (PARTITION BY vec_id ORDER BY distance, bin)),
pr AS (SELECT vec_id, bin, distance, length FROM k WHERE p = 1 AND (nx IS NULL OR distance <= {RATIO} * nx))"""
_TIES = f"t AS (SELECT c_custkey AS u, {TIE} AS v FROM customer), b AS (SELECT u, v FROM t UNION SELECT v, u FROM t)"

SQL = {
    "q41_centroid_ratio": f"""WITH {_NEAR}, k AS (SELECT vec_id, bin, distance, row_number() OVER w AS p, lead(distance) OVER w AS nx, count(*) OVER (PARTITION BY vec_id) AS reached FROM near WINDOW w AS (PARTITION BY vec_id ORDER BY distance, bin))
SELECT vec_id, bin AS nearest, round(distance, 6) AS distance, reached, nx IS NULL OR distance <= {RATIO} * nx AS clear FROM k WHERE p = 1""",
    "q240_components": f"WITH RECURSIVE {_TIES}, r AS (SELECT u AS node, v AS other FROM b UNION SELECT node, b.v FROM r JOIN b ON b.u = other) SELECT node, min(least(node, other)) AS component FROM r GROUP BY node",
    "q241_layers": f"""WITH RECURSIVE {_TIES}, r AS (SELECT node, 0 AS layer FROM (SELECT c_custkey AS node FROM customer WHERE c_nationkey = 7) UNION SELECT v, layer + 1 FROM r JOIN b ON u = node WHERE u <> v AND layer < 40)
SELECT node, CAST(min(layer) AS BIGINT) AS layer FROM r GROUP BY node""",
    "q242_proposals": f"WITH {_PROPOSED} SELECT vec_id, bin, round(distance, 6) AS distance FROM pr",
    "q243_recruited": f"""WITH RECURSIVE {_PROPOSED}, o AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY distance, vec_id) AS k FROM pr),
f AS (SELECT DISTINCT bin, CAST(0 AS BIGINT) AS k, CAST({CAP} - {HELD} AS BIGINT) AS room, false AS taken FROM o UNION ALL SELECT o.bin, o.k, CASE WHEN length <= room THEN room - length ELSE room END, length <= room FROM f JOIN o ON o.bin = f.bin AND o.k = f.k + 1)
SELECT vec_id, o.bin, round(distance, 6) AS distance, taken FROM o JOIN f ON f.bin = o.bin AND f.k = o.k""",
}
QUERIES = {n: f for n, f in list(globals().items()) if n[0] == "q" and n[1:2].isdigit()}
