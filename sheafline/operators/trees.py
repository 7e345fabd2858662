"""Trees in Newick form as rows: a table of texts becomes a table of nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .checks import running

#: Quoted names, marks, and plain names.
TOKEN = r"('[^']*+(?:''[^']*+)*+'|[(),:;]|[^\s(),:;']+)"


def tokens(trees: DataFrame, tree: str, text: str) -> DataFrame:
    """tree, i, token and depth, the number of brackets open after the token, up to the first semicolon."""
    split = trees.select(tree, F.posexplode(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1))).alias("i", "token"))
    end = split.where("token = ';'").groupBy(F.col(tree).alias("_t")).agg(F.min("i").alias("_end"))
    split = split.join(end, F.col(tree).eqNullSafe(F.col("_t")), "left").where("_end IS NULL OR i < _end").drop("_t", "_end")
    step = F.when(F.col("token") == "(", 1).when(F.col("token") == ")", -1).otherwise(0)
    return running(split, [F.col("i")], step, "depth", [tree])


def problems(scanned: DataFrame, tree: str) -> DataFrame:
    """tree and problem of texts whose brackets do not match."""
    last = scanned.groupBy(tree).agg(F.min("depth").alias("least"), F.max_by("depth", "i").alias("final"))
    return last.select(tree, F.when(F.col("least") < 0, "a bracket closes that was not opened").when(F.col("final") != 0, "a bracket is not closed").alias("problem")).where("problem IS NOT NULL")


def nodes(trees: DataFrame, tree: str, text: str) -> DataFrame:
    """tree, node, parent, label, length, depth and leaf of all trees; a node is known by the place of its token.

    A leaf is a name that follows an opening bracket, a comma or nothing; an inner node is a closing bracket, and the name after it is
    its label. The number after a colon is the length of the node before it (at least 0; null without one). A node's parent is the next closing bracket
    after which one bracket less is open: closing brackets and nodes meet by tree and depth, so a task needs one level of a tree at most. A tree
    whose brackets do not match is an error.
    """
    scanned = written(tokens(trees, tree, text), "tokens")
    if wrong := problems(scanned, tree).limit(1).collect():
        raise ValueError(f"{wrong[0][tree]}: {wrong[0]['problem']}")
    # the tokens around one, across the borders of stretches of 4096 tokens, which are repeated at the neighbours' edges
    edge = scanned.select("*", F.explode(F.array(F.lit(-3), F.lit(-2), F.lit(-1), F.lit(0), F.lit(1))).alias("_o")).where("_o = 0 OR floor((i + _o) / 4096) <> floor(i / 4096)")
    stretch = F.floor((F.col("i") + F.col("_o")) / 4096)
    w = Window.partitionBy(tree, "_s").orderBy("i")
    near = edge.withColumn("_s", stretch).dropDuplicates([tree, "_s", "i"]).select("*", F.lag("token").over(w).alias("_before"), *[F.lead("token", k).over(w).alias(f"_n{k}") for k in (1, 2, 3)]).where(F.floor(F.col("i") / 4096) == F.col("_s"))
    mark = F.col("token").isin("(", ")", ",", ":")
    leaf = ~mark & (F.col("_before").isNull() | F.col("_before").isin("(", ","))
    inner = F.col("token") == ")"
    plain = lambda c: F.when(c.startswith("'"), F.replace(F.substring(c, 2, F.length(c) - 2), F.lit("''"), F.lit("'"))).otherwise(c)
    named = inner & F.col("_n1").isNotNull() & ~F.col("_n1").isin("(", ")", ",", ":")
    label = F.when(leaf, plain(F.col("token"))).when(named, plain(F.col("_n1")))
    length = F.when(F.when(named, F.col("_n2")).otherwise(F.col("_n1")) == ":", F.when(named, F.col("_n3")).otherwise(F.col("_n2")))
    found = written(near.where(leaf | inner).select(tree, F.col("i").alias("node"), label.alias("label"), F.when(length.isNotNull(), F.greatest(F.lit(0.0), length.try_cast("double"))).alias("length"), "depth", leaf.alias("leaf")), "nodes")
    asks = found.select(tree, (F.col("depth") - 1).alias("_d"), F.col("node").alias("_i"), F.lit(None).cast("int").alias("_close"))
    closes = found.where("NOT leaf").select(tree, F.col("depth").alias("_d"), F.col("node").alias("_i"), F.col("node").alias("_close"))
    after = Window.partitionBy(tree, "_d").orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, -1)
    parents = asks.unionByName(closes).withColumn("parent", F.min("_close").over(after)).where("_close IS NULL").select(tree, F.col("_i").alias("node"), "parent")
    return found.join(parents, [tree, "node"], "left").select(tree, "node", "parent", "label", "length", "depth", "leaf")
