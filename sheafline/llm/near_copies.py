"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

A document's shingles are all runs of five words (all its words, if fewer). Texts that are equal are one node. Each node
has a signature per tree, LEVELS min-hashes of two bytes in a row. A tree is the sorted list of these, which is a prefix trie:
two nodes meet at a depth if all signatures between them agree in a prefix of that length. All trees are sorted together, over
the whole cluster; a task walks along its part once and notes, for every depth, the first node of the run that each node is in.

Prefixes are matched at full depth first. The candidates are compared exactly, and each link found with similarity s counts
1 / p(s) times, p(s) = 1 - (1 - s^depth)^trees being the chance to find it at that depth: this estimates how many links there
are. While those found are less than TARGET of the estimate, all prefixes are shortened by one level, down to SHORTEST, and
the groups that have grown are compared again.

Nodes of a run are tied to its first node; the connected groups of these ties hold all candidate pairs. Texts that have a
template in common can chain up to a huge group in which hardly any two are alike. A group of more than SPLIT nodes is
therefore split first: put the shingles of a text in order of how many of the group hold them, rarest first; two texts of
similarity t share one of the first n - ceil(t n) + 1 of their n shingles, whatever the order is. Nodes that share such a
rare shingle are in one part, a template's own shingles come last and tie nothing, and no link joins two parts.

The pairs within a part are compared exactly, on whole shingle sets, in blocks of at most BLOCK nodes: a large part becomes
many tasks. A task returns, for each of its nodes, the number of partners, and a spanning forest of its links, never the
pairs. Classes are the connected components of the links.

Null texts and texts without words are alone. Repeated rows are copies of each other. Empty tables give empty results.
Texts are told apart by a 64-bit hash.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, packed, texts, written
from .components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHINGLE, THRESHOLD, TREES, LEVELS, SHORTEST, TARGET, BLOCK = 5, 0.8, 32, 8, 4, 0.9995, 256
SPLIT = 4096
#: Cells of the histogram of the similarities found, from the threshold to 1.
CELLS = 50


def missed(found: dict[int, int], depth: int, threshold: float = THRESHOLD, trees: int = TREES) -> float:
    """Estimate of the links not found at a depth: each one found stands for (1 - p) / p others; found counts links by cell."""
    total = 0.0
    for cell, n in found.items():
        s = threshold + (1 - threshold) * cell / CELLS
        p = 1 - (1 - s**depth) ** trees
        total += n * (1 - p) / p
    return total


def shingles(text: str, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of n words."""
    import xxhash

    words = WORD.findall(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)]
        out ^= out >> np.uint64(31)
    out = out * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(out ^ (out >> np.uint64(32)))


@lru_cache(maxsize=4)
def _family(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(2024))
    return rng.integers(0, 2**32, (size, 1), np.uint32) | np.uint32(1), rng.integers(0, 2**32, (size, 1), np.uint32)


def signature(found: np.ndarray, trees: int = TREES, levels: int = LEVELS) -> bytes:
    """The min-hashes of all trees, two bytes each, a tree's in a row."""
    a, b = _family(trees * levels)
    low = (found >> np.uint64(16)).astype(np.uint32)
    least = np.full(trees * levels, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        part = (low[None, at : at + 2048] ^ b) * a
        np.minimum(least, part.min(axis=1), out=least)
    least = (least ^ (least >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (least >> np.uint32(16)).astype(">u2").tobytes()


def signed(docs: DataFrame, trees: int = TREES, levels: int = LEVELS) -> DataFrame:
    """doc_id, node (hash of the text) and signature (null without words)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [shingles(t.as_py()) for t in part.column(2)]
                sig = [signature(x, trees, levels) if len(x) else None for x in found]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sig, pa.binary())], ["doc_id", "node", "sig"])

    keyed = texts(docs).select("doc_id", F.xxhash64("text").alias("node"), "text")
    return keyed.mapInArrow(run, "doc_id long, node long, sig binary")


TRIE = "node long, leads array<long>, edge int, task int, tree int, key binary"


def trie(nodes: DataFrame, trees: int = TREES, levels: int = LEVELS, shortest: int = SHORTEST) -> DataFrame:
    """The sorted signatures of all trees, as far as they share a prefix: node and leads, the first node of its run at each
    depth from shortest to levels. Rows with an edge are the first (1) and the last (2) of a task, for the runs that go on."""

    def run(batches):
        from pyspark import TaskContext

        task, last = TaskContext.get().partitionId(), None
        depths = np.arange(shortest, levels + 1)

        def edge(kind, tree, key, node, leads):
            cols = [[int(node)], [leads.tolist()], [kind], [task], [int(tree)], [key]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        names = [x.split()[0] for x in TRIE.split(", ")]
        types = [pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            if not batch.num_rows:
                continue
            tree, node, keys = batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(1).to_pylist()
            key = np.frombuffer(b"".join(keys), ">u2").reshape(len(keys), levels)
            if last is None:
                yield edge(1, tree[0], keys[0], node[0], np.full(len(depths), node[0]))
                last = (tree[0], key[0], node[0], np.full(len(depths), node[0]))
            same = np.vstack([last[1], key[:-1]]) == key
            shared = np.where(np.concatenate([[last[0]], tree[:-1]]) == tree, np.cumprod(same, axis=1).sum(axis=1), 0)
            # the row at which each one's run begins, 0 for the runs of the batch before
            begins = np.where(shared[:, None] < depths, np.arange(1, len(node) + 1)[:, None], 0)
            begins = np.maximum.accumulate(begins, axis=0)
            leads = np.where(begins == 0, last[3], node[np.maximum(begins - 1, 0)])
            kept = np.flatnonzero((shared >= shortest) & (leads != node[:, None]).any(axis=1))
            if len(kept):
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1) * len(depths), pa.int32()), pa.array(leads[kept].ravel()))
                none = lambda t: pa.nulls(len(kept), t)
                yield pa.RecordBatch.from_arrays([pa.array(node[kept]), flat, pa.array(np.zeros(len(kept), np.int32)), none(pa.int32()), none(pa.int32()), none(pa.binary())], names)
            last = (tree[-1], key[-1], node[-1], leads[-1])
        if last is not None:
            yield edge(2, last[0], last[1].tobytes(), last[2], last[3])

    keys = F.array(*[F.expr(f"substring(sig, {2 * levels * t + 1}, {2 * levels})") for t in range(trees)])
    rows = nodes.where("sig IS NOT NULL").select("node", F.posexplode(keys).alias("tree", "key")).select("tree", "key", "node")
    order = ["tree", "key", "node"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, TRIE)


def joints(found: DataFrame, levels: int = LEVELS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(depth, node, node) where a run goes on from one task to the next; two rows for each task are all that is looked at."""
    out, before = [], None
    for r in sorted(found.where("edge > 0").collect(), key=lambda r: (r["task"], r["edge"])):
        if r["edge"] == 1 and before is not None and before["tree"] == r["tree"]:
            a, b = (np.frombuffer(bytes(x["key"]), ">u2") for x in (before, r))
            shared = int(np.cumprod(a == b).sum())
            out += [(d, r["node"], before["leads"][d - shortest]) for d in range(shortest, shared + 1)]
        before = r if r["edge"] == 2 else before
    return out


def groups(found: DataFrame, across: list[tuple[int, int, int]], depth: int, before: DataFrame | None = None, shortest: int = SHORTEST) -> DataFrame:
    """node and component for all nodes that share a prefix of a depth with another one; found: trie(), across: joints().

    before holds the groups of the next longer prefix: then only the ties that are new join them.
    """
    rows, lead = found.where("edge = 0"), F.col("leads")[depth - shortest]
    if before is not None:
        rows = rows.where(lead != F.col("leads")[depth + 1 - shortest])
    ties = rows.select(F.col("node").alias("u"), lead.alias("v")).where("u <> v").distinct()
    over = [(u, v) for d, u, v in across if d == depth and u != v]
    ties = ties.unionByName(found.sparkSession.createDataFrame(over, "u long, v long")) if over else ties
    if before is None:
        # the runs of a group in all trees have few least nodes, but as many first ones as trees: tied to the former, most ties are one
        least = ties.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        ends = F.explode(F.array("u", "v")).alias("u")
        return components(ties.join(apart(least), "v").select(ends, F.col("m").alias("v")).where("u <> v").distinct())
    of = lambda c: before.select(F.col("node").alias(c), F.col("component").alias(f"{c}_group"))
    named = ties.join(apart(of("u")), "u", "left").join(apart(of("v")), "v", "left")
    joined = written(components(named.select(F.coalesce("u_group", "u").alias("u"), F.coalesce("v_group", "v").alias("v")).where("u <> v").distinct()), "joined-groups")
    moved = before.join(apart(joined.select(F.col("node").alias("component"), F.col("component").alias("now"))), "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    return moved.unionByName(joined.join(before.select("node"), "node", "left_anti").select("node", "component"))


def bodies(docs: DataFrame, nodes: DataFrame, found: DataFrame, across: list[tuple[int, int, int]]) -> DataFrame:
    """node and text of the nodes that share even the shortest prefix with another one; the documents are shuffled here alone."""
    met = found.where("edge = 0").select(F.explode(F.array_append("leads", F.col("node"))).alias("node"))
    over = [(x,) for d, u, v in across for x in (u, v)]
    met = met.unionByName(found.sparkSession.createDataFrame(over, "node long")) if over else met
    wanted = met.distinct().join(nodes.select("node", F.col("doc_id").alias("rep")), "node")
    one = texts(docs).select("doc_id", F.xxhash64("text").alias("node"), "text")
    # of the same kind at every size: the list of nodes grows with the corpus
    return one.join(wanted.hint("merge"), (one["node"] == wanted["node"]) & one["doc_id"].eqNullSafe(wanted["rep"])).select(wanted["node"], "text").dropDuplicates(["node"])


VERIFIED = "component long, u long, v long, links long, cell int"


def _verify(threshold: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        component, _, i, j = key
        pdf = pdf.sort_values("node", kind="stable").reset_index(drop=True)
        sets = [shingles(t) for t in pdf["text"]]
        sizes = np.array([len(s) for s in sets])
        vocab, code = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        nodes, copies, side = pdf["node"].to_numpy(), pdf["copies"].to_numpy(), pdf["block"].to_numpy()
        links, root, forest, cells = np.zeros(len(pdf), np.int64), list(range(len(pdf))), [], np.zeros(CELLS + 1, np.int64)

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for k in range(len(pdf) - 1):
            mine = np.zeros(len(vocab), np.int64)
            mine[code[starts[k] : starts[k] + sizes[k]]] = 1
            common = np.add.reduceat(mine[code[starts[k + 1] :]], starts[k + 1 :] - starts[k + 1])
            near = common >= threshold * (sizes[k] + sizes[k + 1 :] - common) - 1e-9
            if i != j:  # pairs within a block belong to the task of that block alone
                near &= side[k + 1 :] != side[k]
            for x in np.flatnonzero(near) + k + 1:
                a, b = top(k), top(x)
                if a != b:
                    root[b] = a
                    forest.append((nodes[k], nodes[x]))
            hit = np.flatnonzero(near) + k + 1
            links[k] += copies[hit].sum()
            links[hit] += copies[k]
            alike = common[near] / (sizes[k] + sizes[hit] - common[near])
            cells += np.bincount(np.clip((alike - threshold) / (1 - threshold) * CELLS, 0, CELLS).astype(int), minlength=CELLS + 1)
        rows = [(component, n, n, c, -1) for n, c in zip(nodes, links, strict=True) if c] + [(component, u, v, 0, -1) for u, v in forest]
        rows += [(component, 0, 0, n, c) for c, n in enumerate(cells) if n]
        return pd.DataFrame(rows, columns=["component", "u", "v", "links", "cell"]).astype({"component": "int64", "u": "int64", "v": "int64", "links": "int64", "cell": "int32"})

    return run


def parted(texts_of: DataFrame, members: DataFrame, threshold: float = THRESHOLD, split: int = SPLIT) -> DataFrame:
    """component, node and part of the members; nodes of a group above split nodes that share no rare shingle with another one are left out."""

    def run(batches):
        for batch in batches:
            for component, node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # a shingle within its group: one 64-bit key
                keys = (shingles(text) ^ (np.array([component]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)
                first = len(keys) - math.ceil(threshold * len(keys) - 1e-9) + 1
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), node)), pa.array(np.full(len(keys), first, np.int32))], ["key", "node", "first"])

    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    sized = written(members.join(apart(sizes), "component"), "sized-groups")
    small = sized.where(F.col("size") <= split).select("component", "node", F.col("component").alias("part"))
    large = sized.where(F.col("size") > split).select("component", "node")
    if large.isEmpty():
        return small
    rows = written(large.join(texts_of, "node").select("component", "node", "text").mapInArrow(run, "key long, node long, first int"), "shingles")
    common = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    order = Window.partitionBy("node").orderBy(F.coalesce("n", F.lit(1)), "key")
    placed = rows.join(apart(common), "key", "left").withColumn("place", F.row_number().over(order))
    rare = written(placed.where("n > 1 AND place <= first").select("key", "node"), "rare-shingles")
    least = rare.groupBy("key").agg(F.min("node").alias("v"))
    ties = rare.join(apart(least), "key").where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    parts = written(components(ties).select("node", F.col("component").alias("part")), "parts")
    return small.unionByName(large.join(parts, "node").select("component", "node", "part"))


def verified(texts_of: DataFrame, nodes: DataFrame, members: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, split: int = SPLIT) -> DataFrame:
    """Partner counts (u = v), links of a spanning forest (u <> v), and links by cell of similarity among the members of each group."""
    members = parted(texts_of, members, threshold, split)
    sizes = members.groupBy("component", "part").agg(F.count("*").alias("size"))
    placed = members.join(apart(sizes), ["component", "part"]).withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("blocks")).cast("int"))
    bodies = placed.join(nodes.select("node", "copies"), "node").join(texts_of, "node")
    pairs = bodies.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    pairs = pairs.select("component", "part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "copies", "block", "text")
    return pairs.groupBy("component", "part", "i", "j").applyInPandas(_verify(threshold), VERIFIED)


def _classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The signed documents, and of each node with words: node, doc_id (its least), class_id, class_node, n_links, n_copies.

    class_id is the least doc_id of the class and class_node its node; where no document has an id, the least node.
    """
    marked = written(signed(docs), "signed")
    nodes = written(marked.where("sig IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("sig").alias("sig")), "nodes")
    sorted_ = written(trie(nodes), "trie")
    across, depth, members, found = joints(sorted_), LEVELS, None, None
    held = written(bodies(docs, nodes, sorted_, across), "bodies")
    while True:
        now = written(groups(sorted_, across, depth, members), "groups")
        if found is None:
            found = written(verified(held, nodes, now, threshold), "links")
        else:
            # groups of the same least node and size are the same groups
            sized = lambda m: m.groupBy("component").agg(F.count("*").alias("n"))
            same = written(sized(members).join(sized(now), ["component", "n"]).select("component"), "same-groups")
            new = verified(held, nodes, now.join(apart(same), "component", "left_anti"), threshold)
            found = written(found.join(apart(same), "component", "left_semi").unionByName(new), "links")
        cells = {r["cell"]: r["n"] for r in found.where("cell >= 0").groupBy("cell").agg(F.sum("links").alias("n")).collect()}
        if depth == SHORTEST or missed(cells, depth, threshold) <= (1 - TARGET) * sum(cells.values()):
            break
        members, depth = now, depth - 1
    found = found.where("cell < 0")
    links = found.where("u = v").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    classes = components(found.where("u <> v").select("u", "v"))
    named = classes.join(nodes.select("node", "doc_id"), "node")
    first = F.min_by("node", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("class_id"), first.alias("class_node"))
    per_node = nodes.select("node", "doc_id", "copies").join(links, "node", "left").join(classes.join(least, "component").select("node", "class_id", "class_node"), "node", "left")
    per_node = per_node.select(
        "node", "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("class_node", "node").alias("class_node"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n_copies")
    )
    return marked, written(per_node, "classes")


def near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), n_links (documents at or above the threshold) and n_copies."""
    marked, per_node = _classes(docs, threshold)
    rows = marked.select("doc_id", F.when(F.col("sig").isNotNull(), F.col("node")).alias("node"))
    out = rows.join(per_node.select("node", "class_id", "n_links", "n_copies"), "node", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with all columns: the text that has the class's least doc_id, in one of its rows with that id.

    Documents are told apart by id and text: null and repeated ids are no copies of each other. All rows without words stay.
    """
    _, per_node = _classes(docs, threshold)
    kept = per_node.where("node = class_node").select(F.col("node").alias("kept"), F.col("doc_id").alias("kept_id"))
    keyed = packed(docs).withColumn("node", F.xxhash64("text"))
    spoken = F.col("text").rlike(WORD.pattern)
    one = keyed.where(spoken).join(kept, (F.col("node") == F.col("kept")) & F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").dropDuplicates(["node"])
    return one.unionByName(keyed.where(~spoken)).select("row.*")
