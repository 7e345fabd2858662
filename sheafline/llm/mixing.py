"""Mixing sources to target weights, in DataFrame expressions only.

Targets: sources in code-point order, null last, weigh WEIGHTS in turn and share SHARE of all words; a target stops at
MOST times its source's size, and what it cannot take is shared by weight among the others (water-filling).

Documents fall into blocks of each source by a hash, as many blocks as there are BLOCK documents, BLOCKS at least. A source
is taken whole as often as its target allows, and the rest of the target by whole blocks in a permuted order; the block that
crosses the target gives documents in a permuted order, and the document that crosses it gives its first words, so that the
words taken are the target to the word. Every pass over a block is an item of its source's block quota, and a splitting tree
deals the quotas to the output shards (a power of two, about SHARD words each, SHARDS at least): at each node the left half's
share of every source is drawn from the multivariate hypergeometric distribution (source after source, by inversion, from
hashed uniform numbers), so that block quotas stay exact and reruns agree. A shard draws disjoint runs of each source's
permuted items, which decides where each copy of a document goes, and shuffles its documents locally, by a hash.

Null texts and texts without words have size 0 and are never taken; documents without source form a source of their own;
repeated rows are documents of their own. Without any words all targets are 0. Extra columns stay, whatever their names.
Sources are few enough that a row for each can be sorted together; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, columns, written
from .quality import log_factorial

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2, 7
#: Least numbers of blocks of a source and of shards; documents of a block and words of a shard, about.
BLOCKS, SHARDS, BLOCK, SHARD = 4096, 16, 20_000, 50_000_000


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, _size, _hash, and the whole row as a struct row, which keeps every column of any name."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(*columns(docs)).alias("row")
    return docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"), F.xxhash64(F.lit(seed), F.col("doc_id"), text).alias("_hash"), row)


def in_blocks(rows: DataFrame, blocks: int, seed: int = SEED) -> DataFrame:
    """The rows with their _block."""
    return rows.withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), "_hash"), F.lit(blocks)).cast("int"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, its place, size and target."""
    per = sizes.groupBy("source").agg(F.sum("_size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per.withColumn("place", F.row_number().over(order) - 1)
    weighed = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    most_of = weighed.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("ratio", F.col("cap") / F.col("weight"))
    first = Window.orderBy("ratio", "place")
    before, rest, whole = first.rowsBetween(Window.unboundedPreceding, -1), first.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    levels = most_of.withColumn("left", F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("level", F.col("left") / F.sum("weight").over(rest))
    filled = levels.withColumn("line", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "place", "level"))).over(whole))
    return filled.select("source", "place", "source_size", F.least("cap", F.coalesce(F.col("weight") * F.col("line.level"), F.col("cap"))).alias("target"))


def _hypergeometric(pop: str, marked: str, drawn: str, u: str) -> str:
    """SQL for a hypergeometric number by inversion, within ten standard deviations of its mean."""
    mean = f"(double({drawn}) * {marked} / greatest({pop}, 1L))"
    sd = f"sqrt({mean} * ({pop} - {marked}) / greatest({pop}, 1L) * ({pop} - {drawn}) / greatest({pop} - 1, 1L))"
    low = f"greatest(0L, {drawn} - ({pop} - {marked}), bigint(floor({mean} - 10 * {sd} - 10)))"
    high = f"least({drawn}, {marked}, bigint(ceil({mean} + 10 * {sd} + 10)))"
    lf = log_factorial
    first = (
        f"exp({lf(marked)} - {lf('lo')} - {lf(f'({marked} - lo)')} + {lf(f'({pop} - {marked})')} - {lf(f'({drawn} - lo)')} "
        f"- {lf(f'({pop} - {marked} - {drawn} + lo)')} - {lf(pop)} + {lf(drawn)} + {lf(f'({pop} - {drawn})')})"
    )
    step = (
        f"(c, i) -> named_struct('x', CASE WHEN c.total < {u} THEN i ELSE c.x END, "
        f"'p', c.p * ({marked} - i) * ({drawn} - i) / ((i + 1) * double({pop} - {marked} - {drawn} + i + 1)), 'total', c.total + c.p)"
    )
    return f"transform(array({low}), lo -> aggregate(sequence(lo, greatest(lo, {high})), named_struct('x', lo, 'p', {first}, 'total', 0D), {step}, c -> c.x))[0]"


def quotas(items: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """place, shard, first and last rank of the items that the shard takes; items: place and n, its number of items."""
    node = items.agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("x")).select(F.lit(1).alias("node"), F.lit(shards).alias("width"), F.lit(0).alias("low"), F.expr("transform(x, y -> y.place)").alias("places"), F.expr("transform(x, y -> y.n)").alias("counts"))
    u = f"(pmod(xxhash64({seed}, node, a.i), 9007199254740992L) / 9007199254740992D)"
    draw = _hypergeometric("a.pop", "k", "a.drawn", u)
    step = f"(a, k) -> transform(array({draw}), x -> named_struct('pop', a.pop - k, 'drawn', a.drawn - x, 'i', a.i + 1, 'out', concat(a.out, array(x))))[0]"
    total = "aggregate(counts, 0L, (s, x) -> s + x)"
    start = f"named_struct('pop', {total}, 'drawn', {total} * (width div 2) div width, 'i', 0, 'out', cast(array() AS array<bigint>))"
    while shards > 1:  # a level of the tree; shards is a power of two
        split = node.withColumn("left", F.expr(f"aggregate(counts, {start}, {step}, a -> a.out)"))
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.expr("width div 2").alias("width"), F.col("low"), F.col("left").alias("counts")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.expr("width div 2").alias("width"), F.expr("low + width div 2").alias("low"), F.expr("zip_with(counts, left, (a, b) -> a - b)").alias("counts")),
        )
        node = split.select("places", F.explode(halves).alias("h")).select("h.node", "h.width", "h.low", "places", "h.counts")
        shards //= 2
    each = node.select(F.col("low").alias("shard"), F.explode(F.arrays_zip(F.col("places").alias("place"), F.col("counts").alias("n"))).alias("x")).select("shard", "x.place", "x.n")
    upto = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    return each.withColumn("last", F.sum("n").over(upto)).select("place", "shard", (F.col("last") - F.col("n")).alias("first"), "last").where("last > first")


def blocks(sizes: DataFrame, aims: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """A row for each source and block: whole passes, words wanted of the next pass, and the shard of each pass."""
    per = sizes.groupBy("source", "_block").agg(F.sum("_size").alias("words"))
    goal = aims.withColumn("quota", F.floor(F.col("target") + 0.5)).withColumn("whole", F.coalesce(F.expr("try_divide(quota, source_size)"), F.lit(0)).cast("int"))
    goal = goal.withColumn("rest", F.col("quota") - F.col("whole") * F.col("source_size"))
    both = per.alias("p").join(goal.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source"))).select("p.source", "p._block", "p.words", "g.place", "g.source_size", "g.target", "g.whole", "g.rest")
    order = Window.partitionBy("place").orderBy(F.xxhash64(F.lit(seed), "place", "_block"), "_block").rowsBetween(Window.unboundedPreceding, -1)
    wanted = both.withColumn("wanted", F.greatest(F.lit(0), F.least("words", F.col("rest") - F.coalesce(F.sum("words").over(order), F.lit(0)))))
    wanted = wanted.withColumn("passes", F.col("whole") + (F.col("wanted") > 0).cast("int"))
    items = wanted.where("passes > 0").select("place", "_block", F.explode(F.sequence(F.lit(1), "passes")).alias("pass"))
    ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(F.xxhash64(F.lit(seed + 1), "place", "_block", "pass"), "_block", "pass")) - 1)
    shares = quotas(items.groupBy("place").agg(F.count("*").alias("n")), shards, seed)
    dealt = ranked.alias("r").join(shares.hint("merge").alias("q"), (F.col("r.place") == F.col("q.place")) & (F.col("r.rank") >= F.col("q.first")) & (F.col("r.rank") < F.col("q.last")))
    lists = dealt.groupBy("r.place", "r._block").agg(F.expr("transform(array_sort(collect_list(struct(r.pass, q.shard))), x -> x.shard)").alias("shards"))
    return wanted.join(lists.hint("merge"), ["place", "_block"], "left").select("source", "_block", "words", "source_size", "target", "whole", "wanted", "shards")


def draw(rows: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows with _source_size, _target, _taken and _draws: an array of shard, order within it, and words taken.

    Only a source's block that crosses its target needs its documents in order; all other blocks are taken whole or not.
    """
    renamed = plan.select(*[F.col(c).alias(f"_plan_{c}") for c in plan.columns])
    both = rows.join(renamed, rows["source"].eqNullSafe(F.col("_plan_source")) & (rows["_block"] == F.col("_plan__block")))
    crossing = (F.col("_plan_wanted") > 0) & (F.col("_plan_wanted") < F.col("_plan_words"))
    before = Window.partitionBy("_plan_source", "_plan__block").orderBy("_hash", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = both.where(crossing).withColumn("_part", F.greatest(F.lit(0), F.least("_size", F.col("_plan_wanted") - F.coalesce(F.sum("_size").over(before), F.lit(0)))))
    some = both.where(~crossing).withColumn("_part", F.when(F.col("_plan_wanted") > 0, F.col("_size")).otherwise(F.lit(0))).unionByName(cut)
    order = f"xxhash64({seed}, i, _hash)"
    whole = f"CASE WHEN _size > 0 AND _plan_whole > 0 THEN transform(sequence(1, _plan_whole), i -> struct(_plan_shards[i - 1] AS shard, {order} AS place, _size AS words)) ELSE cast(array() AS array<struct<shard:int,place:bigint,words:bigint>>) END"
    part = f"CASE WHEN _part > 0 THEN array(struct(_plan_shards[_plan_whole] AS shard, {order.replace('i,', '0,')} AS place, _part AS words)) ELSE cast(array() AS array<struct<shard:int,place:bigint,words:bigint>>) END"
    drawn = some.withColumn("_draws", F.expr(f"concat({whole}, {part})"))
    return drawn.withColumn("_taken", F.expr("aggregate(_draws, 0L, (a, x) -> a + x.words)")).withColumn("_source_size", F.col("_plan_source_size")).withColumn("_target", F.col("_plan_target")).drop(*renamed.columns, "_part")


def _power(n: float, least: int) -> int:
    """The first power of two from least on that is not under n."""
    while least < n:
        least *= 2
    return least


def prepare(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame, int]:
    """The measured sizes without the rows, the plan for every block (both written), and the number of blocks of a source."""
    sizes = written(measured(docs.select("doc_id", "text", "source"), seed).drop("row"), "mixing-sizes")
    n = sizes.agg(F.count("*").alias("docs"), F.coalesce(F.sum("_size"), F.lit(0)).alias("words")).first()
    count = _power(n["docs"] / BLOCK, BLOCKS)
    sizes = in_blocks(sizes, count, seed)
    plan = blocks(sizes, targets(sizes), shards or _power(SHARE * n["words"] / SHARD, SHARDS), seed)
    return sizes, written(plan, "mixing-plan"), count


def drawn(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken and draws, shard:words for each draw, of every document."""
    sizes, plan, _ = prepare(docs, shards, seed)
    show = F.expr("array_join(transform(_draws, x -> concat(x.shard, ':', x.words)), ',')")
    return draw(sizes, plan.hint("merge"), seed).select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"), show.alias("draws"))


def placed(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """row (a struct of the document's columns, a document taken in part with its first words), shard and place, once for each draw."""
    _, plan, count = prepare(docs, shards, seed)
    # the plan grows with the corpus: Spark sends it to every task only while the written table is under its threshold
    each = draw(in_blocks(measured(docs, seed), count, seed), plan, seed).select("row", "_size", F.explode("_draws").alias("_draw"))
    first = F.expr(r"array_join(slice(filter(split(row.text, '[\\x20\\x09-\\x0D]+'), w -> w != ''), 1, int(_draw.words)), ' ')")
    text = F.when(F.col("_draw.words") < F.col("_size"), first).otherwise(F.col("row.text"))
    return each.select(F.col("row").withField("text", text).alias("row"), "_draw.shard", "_draw.place")


def mixture(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mixed documents with their own columns, shard after shard and in the shuffled order within each.

    Tasks take ranges of shards and places, so that a shard may be larger than a task.
    """
    order = ["shard", "place"]
    return placed(docs, shards, seed).repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")
