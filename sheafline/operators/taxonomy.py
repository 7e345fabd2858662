"""Taxonomies: merged identifiers, lineages, names by rank, anchors, categories, votes and matches with abundances.

nodes has taxid, parent and rank; names has taxid and name; merged has old and new. A root is its own parent or has none.
Loops over levels end when nothing changes and are cut off by tables in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import graph
from .checks import running
from .graph import cut

RANKS = ["domain", "kingdom", "phylum", "class", "order", "family", "genus", "species"]
# Taxa that decide a category, in the order in which they are looked for, and the root of the viruses.
CATEGORIES = [((33208, 3193), "excluded_animal_or_land_plant"), ((2,), "Bacteria"), ((2157,), "Archaea"), ((4751,), "Fungi"), ((2759,), "Other_eukaryote_putative_protist")]
VIRUSES = 10239


def resolve_merged(ids: DataFrame, merged: DataFrame, most: int = 1000) -> DataFrame:
    """taxid and current for each distinct taxid: merged ones are followed to the end; a circle ends where it is met again."""
    todo = ids.select("taxid").distinct().select("taxid", F.col("taxid").alias("current"), F.array().cast("array<long>").alias("seen"))
    done = None
    links = merged.select(F.col("old").cast("long").alias("old"), F.col("new").cast("long").alias("new"))
    for _ in range(most):
        step = todo.join(links, F.col("current") == F.col("old"), "left").withColumn("_go", F.col("new").isNotNull() & ~F.array_contains("seen", F.col("current").cast("long")))
        step = cut(step)
        ended = step.where("NOT _go").select("taxid", "current")
        done = ended if done is None else done.unionByName(ended)
        todo = step.where("_go").select("taxid", F.col("new").alias("current"), F.array_append("seen", F.col("current").cast("long")).alias("seen"))
        if todo.isEmpty():
            return done
    raise ValueError(f"merged identifiers are chained more than {most} times")


def lineages(closure: DataFrame, nodes: DataFrame, names: DataFrame) -> DataFrame:
    """taxid, rank, name and distance of the nearest named ancestor at each rank; closure: node, ancestor, distance.

    superkingdom counts as domain; a name that is not known is the identifier; taxa below the viruses have that domain.
    """
    rank = F.when(F.col("rank") == "superkingdom", "domain").otherwise(F.col("rank"))
    ranked = nodes.select(F.col("taxid").alias("ancestor"), rank.alias("rank")).where(F.col("rank").isin(RANKS))
    named = closure.join(ranked, "ancestor").join(names.select(F.col("taxid").alias("ancestor"), "name"), "ancestor", "left").withColumn("name", F.coalesce("name", F.col("ancestor").cast("string")))
    near = named.groupBy(F.col("node").alias("taxid"), "rank").agg(F.min_by("name", "distance").alias("name"), F.min("distance").alias("distance"))
    viral = closure.where(F.col("ancestor") == VIRUSES).select(F.col("node").alias("taxid"), F.lit("domain").alias("rank"), F.lit("Viruses").alias("name"), "distance")
    return near.unionByName(viral.join(near, ["taxid", "rank"], "left_anti"))


def anchors(closure: DataFrame, nodes: DataFrame, ranks: tuple[str, ...] = ("genus", "family", "order")) -> DataFrame:
    """taxid and its anchor: the nearest ancestor of the first rank that it has, 0 if none."""
    at = F.element_at(F.create_map(*[x for i, r in enumerate(ranks) for x in (F.lit(r), F.lit(i))]), F.col("rank"))
    ranked = nodes.where(F.col("rank").isin(*ranks)).select(F.col("taxid").alias("ancestor"), at.alias("place"))
    found = closure.join(ranked, "ancestor").groupBy("node").agg(F.min_by("ancestor", F.struct("place", "distance")).alias("anchor"))
    return closure.select("node").distinct().join(found, "node", "left").select(F.col("node").alias("taxid"), F.coalesce("anchor", F.lit(0)).alias("anchor"))


def categories(closure: DataFrame, rules=CATEGORIES) -> DataFrame:
    """taxid and category: the first rule of which an ancestor is in the lineage."""
    place = F.lit(None).cast("int")
    for k, (taxa, _) in reversed(list(enumerate(rules))):
        place = F.when(F.col("ancestor").isin(*taxa), k).otherwise(place)
    per = closure.groupBy("node").agg(F.min(place).alias("k"))
    name = F.element_at(F.array(*[F.lit(n) for _, n in rules]), F.col("k") + 1)
    return per.select(F.col("node").alias("taxid"), F.when(F.col("k").isNull(), "Unknown_or_other").otherwise(name).alias("category"))


def gene_votes(hits: DataFrame, closure: DataFrame, keep: float = 0.9) -> DataFrame:
    """gene and taxid: the common ancestor of the taxa of a gene's hits within a share of its best score.

    hits: gene, score, taxid (resolved; null if unknown). Genes without a known taxon or a common one are left out.
    """
    best = hits.groupBy("gene").agg(F.max("score").alias("best"))
    near = hits.join(best, "gene").where((F.col("score") >= F.lit(keep) * F.col("best")) & F.col("taxid").isNotNull()).select("gene", F.col("taxid").alias("node"))
    return graph.common_ancestor(near, "gene", closure).select("gene", F.col("lca").alias("taxid"))


def contig_consensus(votes: DataFrame, closure: DataFrame, share: float = 0.7) -> DataFrame:
    """contig, taxid, support and genes: the deepest taxon that a share of a contig's votes (contig, taxid) lie under, each vote once."""
    total = votes.groupBy("contig").agg(F.count("*").alias("genes"))
    depth = closure.groupBy(F.col("node").alias("ancestor")).agg(F.max("distance").alias("depth"))
    held = votes.join(closure, votes["taxid"] == closure["node"]).groupBy("contig", "ancestor").agg(F.count("*").alias("n")).join(total, "contig").where(F.col("n") >= F.lit(share) * F.col("genes"))
    deep = held.join(depth, "ancestor").groupBy("contig").agg(F.min_by(F.struct("ancestor", "n"), F.struct(-F.col("depth"), F.col("ancestor"))).alias("x"))
    return total.join(deep, "contig", "left").select("contig", F.col("x.ancestor").alias("taxid"), F.round(F.coalesce(F.col("x.n") / F.col("genes"), F.lit(0.0)), 6).alias("support"), F.col("genes").cast("long").alias("genes"))


def lineage_tokens(text: Column) -> Column:
    """The tokens of a lineage, trimmed and in small letters."""
    return F.transform(F.split(text, ";"), lambda x: F.lower(F.trim(x)))


def taxa_list(text: Column) -> Column:
    """Distinct taxa of a field parted by ; or <>, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(text, ";|<>"), lambda x: F.trim(x)), lambda x: x != ""))


def abundances(rows: DataFrame) -> DataFrame:
    """Retained flag, reason, rank among the retained and shares of all and of retained counts; rows: lineage, count.

    Ranks order the whole table, so rows are numbered in sorted parts, each after the retained rows of the parts before it.
    """
    tokens = lineage_tokens(F.col("lineage"))
    outside, inside = F.array(*map(F.lit, ("metazoa", "animalia", "embryophyta"))), F.array(*map(F.lit, ("bacteria", "archaea", "eukaryota", "eukaryotes", "eukarya")))
    kept = F.arrays_overlap(tokens, inside) & ~F.arrays_overlap(tokens, outside)
    marked = rows.withColumn("retained", kept)
    total = marked.agg(F.sum("count").alias("_all"), F.sum(F.when(F.col("retained"), F.col("count"))).alias("_kept"))
    placed = running(marked, [F.desc("count"), F.col("lineage")], F.col("retained").cast("int"), "_rank")
    out = placed.join(F.broadcast(total))  # one row
    share = lambda whole: F.round(F.coalesce(F.col("count") / F.when(F.col(whole) > 0, F.col(whole)), F.lit(0.0)), 8)
    return out.select(
        "lineage", "count", "retained", F.when(F.col("retained"), "retained").otherwise("animal/land-plant-or-unresolved-lineage").alias("reason"),
        F.when(F.col("retained"), F.col("_rank")).cast("long").alias("rank_retained"), share("_all").alias("fraction_all"), F.when(F.col("retained"), share("_kept")).otherwise(F.lit(0.0)).alias("fraction_retained"),
    )


def corroboration(taxa: DataFrame, abundance: DataFrame) -> DataFrame:
    """taxid, matched counts and best retained rank: a token of a retained lineage equals one of the taxon's names.

    taxa: taxid, name (one row for each name of the lineage); abundance: abundances(). A lineage counts once for a taxon.
    """
    tokens = abundance.where("retained").select("lineage", "count", "rank_retained", F.explode(F.array_distinct(lineage_tokens(F.col("lineage")))).alias("token"))
    wanted = taxa.select("taxid", F.lower("name").alias("token")).distinct()
    met = wanted.join(tokens, "token").select("taxid", "lineage", "count", "rank_retained").distinct()
    per = met.groupBy("taxid").agg(F.sum("count").alias("matched"), F.min("rank_retained").alias("best_rank"))
    return taxa.select("taxid").distinct().join(per, "taxid", "left").select("taxid", F.coalesce("matched", F.lit(0)).alias("matched"), "best_rank")
