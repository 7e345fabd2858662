"""Oriented overlap graphs: canonical edges, neighbourhoods, exact matches, closures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written


def reverse_complement(seq: Column) -> Column:
    """The other strand, with ambiguity codes."""
    # The complement of each nucleotide code.
    return F.reverse(F.translate(seq, "ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN"))


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Distinct bidirected edges (s, so, t, to): an edge and its reverse complement are one, kept in its smaller form."""
    flip = lambda c: F.when(F.col(c) == "+", "-").otherwise("+")
    a = F.struct(F.col("s").alias("s"), F.col("so").alias("so"), F.col("t").alias("t"), F.col("to").alias("to"))
    b = F.struct(F.col("t").alias("s"), flip("to").alias("so"), F.col("s").alias("t"), flip("so").alias("to"))
    return edges.select(F.least(a, b).alias("e")).select("e.*").distinct()


def within_hops(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """Nodes within so many steps of a seed, with the least number of steps; edges (u, v) go both ways, seeds has node.

    Each step joins the frontier alone with the edges, keeps the least step of a node, and is cut off from the plan.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct()
    reached = frontier = seeds.select("node").distinct().withColumn("hop", F.lit(0).cast("long"))
    for k in range(1, hops + 1):
        met = frontier.join(both, frontier["node"] == both["u"]).select(F.col("v").alias("node")).distinct()
        frontier = cut(met.join(reached.select("node"), "node", "left_anti").withColumn("hop", F.lit(k).cast("long")))
        reached = reached.unionByName(frontier)
    return reached


def induced(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges (u, v) of which both ends are among the nodes."""
    n = nodes.select("node").distinct()
    return edges.join(n.select(F.col("node").alias("u")), "u", "left_semi").join(n.select(F.col("node").alias("v")), "v", "left_semi")


def end_overlaps(seqs: DataFrame, k: int) -> DataFrame:
    """Oriented overlaps of k letters: the last k letters of one oriented sequence are the first k of another one.

    seqs has id and seq. Only runs of the four letters count, and sequences must be longer than k. Only the ends are cut out
    and complemented. Each edge is kept in its canonical form. A k-mer at which many ends meet gives all pairs of them, which
    is what the graph holds there; ends(seqs, k) counts them first.
    """
    cut_ = ends(seqs, k)
    last = cut_.select(F.col("id").alias("s"), F.col("o").alias("so"), F.col("last").alias("kmer")).where(F.col("kmer").rlike("^[ACGT]+$"))
    first = cut_.select(F.col("id").alias("t"), F.col("o").alias("to"), F.col("first").alias("kmer"))
    return canonical_edges(last.join(first, "kmer").select("s", "so", "t", "to"))


def ends(seqs: DataFrame, k: int) -> DataFrame:
    """id, o, first and last: the k letters at the ends of each oriented sequence longer than k."""
    both = seqs.where(F.length("seq") > k).select("id", F.expr(f"left(seq, {k})").alias("a"), F.expr(f"right(seq, {k})").alias("b"))
    turned = F.struct(F.lit("-").alias("o"), reverse_complement(F.col("b")).alias("first"), reverse_complement(F.col("a")).alias("last"))
    return both.select("id", F.explode(F.array(F.struct(F.lit("+").alias("o"), F.col("a").alias("first"), F.col("b").alias("last")), turned)).alias("x")).select("id", "x.*")


def keyed(seqs: DataFrame, key: str) -> DataFrame:
    """key, length and SHA-256 of each sequence and of its other strand; the sequences themselves stay behind."""
    return seqs.select(key, F.length("seq").alias("n"), F.sha2("seq", 256).alias("h"), F.sha2(reverse_complement(F.col("seq")), 256).alias("r"))


def unique_match(queries: DataFrame, segments: DataFrame) -> DataFrame:
    """The one segment that equals a query on either strand; none or several give a reason instead.

    queries: qid, seq; segments: sid, seq. Sequences meet by length and SHA-256 of themselves; the segments of a key are
    counted before the join, so that many equal ones are one row.
    """
    return matched(queries.select("qid", F.length("seq").alias("n"), F.sha2("seq", 256).alias("h")), keyed(segments, "sid"))


def matched(wanted: DataFrame, segments: DataFrame) -> DataFrame:
    """unique_match() of what is left of the sequences: wanted has qid, n and h, segments have sid, n, h and r, as keyed() gives them."""
    both = segments.select("sid", "n", F.explode(F.array(F.struct(F.lit("+").alias("o"), F.col("h")), F.struct(F.lit("-").alias("o"), F.col("r").alias("h")))).alias("x"))
    per = both.groupBy("n", F.col("x.h").alias("h")).agg(F.countDistinct("sid").alias("hits"), F.min("sid").alias("sid"), F.min("x.o").alias("orient"))
    one = F.col("hits") == 1
    reason = F.when(one, "unique_exact_sequence").when(F.col("hits") > 1, "ambiguous_exact_sequence").otherwise("no_exact_segment_match")
    return wanted.join(per, ["n", "h"], "left").select("qid", F.when(one, F.col("sid")).alias("sid"), F.when(one, F.col("orient")).alias("orient"), reason.alias("method"))


def resolve_contigs(contigs: DataFrame, aliases: DataFrame, paths: DataFrame, segments: DataFrame) -> DataFrame:
    """contig, place (a path or segment), orient and method, or the reason why a contig has no place in the graph.

    contigs: contig, seq (null if unknown); aliases: contig, alias; paths: path; segments: segment, length, seq (null if not
    recorded). A recorded alias goes before the contig's own name; a path goes before a segment of the name, and a segment counts only
    if its content agrees as far as it is known; contigs without a name in the graph are looked up by their sequence. Each sequence is
    read once, for its length and its hashes.
    """
    asked = written(contigs.select("contig", F.length("seq").alias("n"), F.sha2("seq", 256).alias("h")), "contigs")
    held = written(segments.select("segment", "length", F.length("seq").alias("n"), F.sha2("seq", 256).alias("h"), F.sha2(reverse_complement(F.col("seq")), 256).alias("r")), "segments")
    key = asked.join(aliases, "contig", "left").select("contig", F.coalesce("alias", "contig").alias("key"), F.col("alias").isNotNull().alias("recorded"), "n", "h")
    p = paths.select(F.col("path").alias("key"), F.lit(True).alias("is_path")).distinct()
    own = held.select(F.col("segment").alias("key"), F.col("h").alias("sh"), F.col("r").alias("sr"), "length", F.lit(True).alias("is_segment"))
    same = matched(asked.where("n IS NOT NULL").select(F.col("contig").alias("qid"), "n", "h"), held.where("n IS NOT NULL").select(F.col("segment").alias("sid"), "n", "h", "r"))
    same = same.select(F.col("qid").alias("contig"), "sid", F.col("orient").alias("match_orient"), F.col("method").alias("match"))
    j = key.join(p, "key", "left").join(own, "key", "left").join(same, "contig", "left")
    known, ahead, back = F.col("n").isNotNull(), F.col("h") == F.col("sh"), F.col("h") == F.col("sr")
    named = F.when(F.col("recorded"), "recorded_segment").otherwise("source_segment_name")
    at_segment = F.when(~known, named).when(F.coalesce(ahead | back, F.lit(False)), named).when(F.col("length").isNotNull() & (F.col("length") != F.col("n")), "source_name_length_mismatch").when(F.col("sh").isNotNull(), "source_name_sequence_mismatch").otherwise(named)
    method = F.when(F.col("is_path"), F.when(F.col("recorded"), "recorded_path").otherwise("source_path_name")).when(F.col("is_segment"), at_segment).when(known, F.col("match")).otherwise("no_recorded_graph_identifier")
    by_name = method.isin("recorded_path", "source_path_name", "recorded_segment", "source_segment_name")
    place = F.when(by_name, F.col("key")).when(method == "unique_exact_sequence", F.col("sid"))
    orient = F.when(method == "unique_exact_sequence", F.col("match_orient")).when(by_name & F.col("is_path").isNull(), F.when(known & F.coalesce(~ahead & back, F.lit(False)), "-").otherwise("+"))
    return j.select("contig", place.alias("place"), orient.alias("orient"), method.alias("method"))


def closure(parents: DataFrame) -> DataFrame:
    """node, ancestor and distance for a tree given as (node, parent), itself included; roots have no parent or themselves.

    Paths are doubled: in each round a path of full length meets the paths from where it ends, so a tree of any depth takes a number
    of rounds that grows as the logarithm of it. A node on a circle, or with two parents, is an error.
    """
    nodes = written(parents.select("node", F.when(F.col("parent") != F.col("node"), F.col("parent")).alias("parent")).distinct(), "tree")
    if not nodes.groupBy("node").count().where("count > 1").isEmpty():
        raise ValueError("a node has two parents")
    known = nodes.count()
    reach = 1
    own = nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).cast("long").alias("distance"))
    paths = written(own.unionByName(nodes.where("parent IS NOT NULL").select("node", F.col("parent").alias("ancestor"), F.lit(1).cast("long").alias("distance"))), "paths")
    while not (ends := paths.where(F.col("distance") == reach)).isEmpty():
        if reach > known:
            raise ValueError("the tree has a circle")
        on = paths.where("distance > 0").select(F.col("node").alias("_n"), F.col("ancestor").alias("_a"), F.col("distance").alias("_d"))
        more = ends.join(on, F.col("ancestor") == F.col("_n")).select("node", F.col("_a").alias("ancestor"), (F.col("distance") + F.col("_d")).alias("distance"))
        paths, reach = written(paths.unionByName(more), "paths"), 2 * reach
    return paths


def cut(df: DataFrame) -> DataFrame:
    """The table without its lineage: written in the shared folder and read again."""
    return written(df, "cut")


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """node and component, the least node of its connected component, for edges (u, v) of any order; self-loops make a node known.

    Large and small stars by turns: every node ties its larger neighbours, then all its smaller ones and itself, to the least node it
    knows, until each component is one star. Only minima are brought together by node, which Spark combines before the shuffle, and
    the joins back are on a key that is unique on one side; so a hub is never gathered, and a chain takes a number of rounds that
    grows as the logarithm of its length. Each round is a written table. Edges with a null end are left out.
    """
    given = written(edges.where("u IS NOT NULL AND v IS NOT NULL").select("u", "v"), "edges")
    now = written(given.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    settled = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    state = settled(now)
    for _ in range(rounds):
        near = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now, before = written(tied.select("e.*").where("u <> v").distinct(), "edges"), state
        state = settled(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = given.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("_c")), "node", "left").select("node", F.coalesce("_c", "node").alias("component"))


def layers(edges: DataFrame, seeds: DataFrame, most: int = 10_000) -> DataFrame:
    """Each node that a seed reaches, with its layer, the least number of edges from a seed; edges (u, v) go both ways, seeds has node.

    One round for each layer, over the edges of its newest nodes alone, until none is new.
    """
    both = written(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct(), "edges")
    newest = reached = written(seeds.where("node IS NOT NULL").select("node").distinct().withColumn("layer", F.lit(0).cast("long")), "layer")
    for k in range(1, most + 1):
        met = newest.join(both, newest["node"] == both["u"]).select(F.col("v").alias("node")).distinct()
        newest = written(met.join(reached.select("node"), "node", "left_anti").withColumn("layer", F.lit(k).cast("long")), "layer")
        if newest.isEmpty():
            return reached
        reached = reached.unionByName(newest)
    raise RuntimeError(f"more than {most} layers")


def common_ancestor(members: DataFrame, group: str, tree: DataFrame, share: float = 1.0) -> DataFrame:
    """The deepest ancestor that holds a share of each group's distinct members; members: group, node; tree: closure()."""
    distinct = members.select(group, "node").distinct()
    total = distinct.groupBy(group).agg(F.count("*").alias("n"))
    height = tree.groupBy("node").agg(F.max("distance").alias("depth"))
    held = distinct.join(tree, "node").groupBy(group, "ancestor").agg(F.count("*").alias("held")).join(total, group).where(F.col("held") >= F.lit(share) * F.col("n"))
    deep = held.join(height, held["ancestor"] == height["node"]).select(group, "ancestor", "depth")
    return deep.groupBy(group).agg(F.min_by("ancestor", F.struct(-F.col("depth"), F.col("ancestor"))).alias("lca"))
