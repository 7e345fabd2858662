"""Phrase collocations by merged stripes, level by level.

A stripe is an associative array of a prefix: next word -> occurrences of prefix + next word. Each block of texts makes its stripes,
they meet by prefix, and are added up elementwise. A merged stripe holds all that is asked of a prefix: its entries are the
counts of its extensions, the sum of its entries (occurrences without a further word included) is the count of the prefix itself,
and its greatest entry says whether an extension subsumes the prefix. The stripe of the empty prefix has the words.

Stripes of k words are made only where it can matter: a phrase occurs at least LEAST times only if its first and its last k - 1
words do. So each block is told which of its own phrases have been found frequent, and keeps the runs of text in which
every phrase of that length is; the next level takes its stripes from the runs. Nothing that grows with the corpus is broadcast.

A block has about BLOCK words of one language, cut between pieces, and its words as numbers. The stripe of a prefix with more than
PART occurrences is kept in 64, 4096, ... sub-stripes by the next word, by the prefix's count in the whole corpus, so that all
blocks agree on them. Stripes are dealt by hash to buckets of about PART occurrences, so a task adds up so many at a time, or one
entry for each block where all of them hold one pair.

Words are told apart by 64-bit hashes (by language), phrases by the hashes of their words. Scores are exact in decimals of 38 digits.
A null text is an empty one, a null language is "und". Documents count as often as they are there. Bytes that are no letter A-Z
are left as they are. Empty tables give an empty result; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

LEAST, LONGEST, TOP, UNKNOWN = 100, 5, 2000, "und"
#: Words of a block, bytes of a text taken at a time, occurrences in a bucket, sub-stripes of a stripe that is split.
BLOCK, CHUNK, PART, SPLIT = 2_000_000, 4_000_000, 250_000, 64
#: Ends a piece; a byte that no text has.
END = b"\xff"
#: Lower-cases A-Z, ends pieces, and makes tabs spaces.
BYTES = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Of the hash of a phrase from the hashes of its words.
FACTOR = np.uint64(0x9E3779B97F4A7C15)

BLOCKS = "lang string, words array<binary>, ids array<bigint>, tokens binary, hot array<bigint>, parts array<bigint>, n long"
#: A row holds a block's stripes of one bucket, end to end: prefixes (hashes) and sizes, then all entries.
STRIPES = "lang string, bucket long, block long, prefix array<bigint>, size array<bigint>, next array<bigint>, n array<bigint>"
MERGED = "block long, lang string, prefix long, next array<bigint>, f array<bigint>, phrase array<bigint>, total long"


def _pack(tokens: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(tokens.astype(np.int32).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int32)


def chunks(data: bytes, size: int):
    """A text in parts of about that many bytes, cut at the ends of pieces."""
    at = 0
    while at < len(data):
        to = data.find(END, at + size)
        to = len(data) if to < 0 else to + 1
        yield data[at:to]
        at = to


class Block:
    """Words of one language as numbers from 1 on; 0 ends a piece."""

    def __init__(self):
        self.number, self.tokens, self.n = {END: 0}, [], 0

    def add(self, data: bytes) -> int:
        found = data.replace(END, b" " + END + b" ").split()
        number = self.number
        ids = np.array([number.setdefault(w, len(number)) for w in found] + [0], np.int32)
        self.tokens.append(ids)
        held = int(np.count_nonzero(ids))
        self.n += held
        return held

    def row(self, lang: str) -> tuple:
        words = list(self.number)[1:]
        ids = np.array([0, *(xxhash.xxh64_intdigest(w, seed=42) for w in words)], np.uint64).astype(np.int64)
        return lang, words, ids[1:], _pack(np.concatenate(self.tokens)), [], [], self.n


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
    columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in BLOCKS.split(", ")])


def _read(size: int, chunk: int):
    """Blocks of about size words from (lang, text); the task holds no more words than that beside one chunk of a text."""

    def run(batches):
        open_: dict[str, Block] = {}
        total = 0
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for part in chunks(data.translate(BYTES), chunk):
                    total += open_.setdefault(lang, Block()).add(part)
                    if total >= size:
                        most = max(open_, key=lambda x: open_[x].n)
                        total -= open_[most].n
                        yield _table([open_.pop(most).row(most)])
        for lang, block in open_.items():
            if block.n:
                yield _table([block.row(lang)])

    return run


def runs(tokens: np.ndarray, k: int) -> np.ndarray:
    """The places at which k words follow one another without an end."""
    ok = tokens != 0
    for _ in range(k - 1):
        ok = ok[:-1] & (tokens[len(tokens) - len(ok) + 1 :] != 0) if len(ok) else ok
    return np.flatnonzero(ok)


def hashes(ids: np.ndarray, tokens: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the phrases of k words at these places; ids: hash of each word's number."""
    h = np.zeros(len(places), np.uint64)
    for j in range(k):
        h = h * FACTOR + ids[tokens[places + j]]
    return h


def _numbers(ids) -> np.ndarray:
    """Hash by number; an end has none."""
    return np.concatenate([np.zeros(1, np.uint64), np.asarray(ids, np.int64).astype(np.uint64)])


def stripes(block: int, lang: str, ids: np.ndarray, tokens: np.ndarray, parts_of: dict[int, int], k: int, buckets: int, parts: int = 1):
    """The block's stripes of all prefixes of k words, as record batches with a row for each bucket that it has any for.

    parts_of: sub-stripes by a prefix's hash, parts: those of the others.
    """
    number = _numbers(ids)
    tokens = np.append(tokens, np.zeros(1, np.int32))
    if k:
        places = runs(tokens, k)
        follows = tokens[places + k]
        prefixes, group = np.unique(hashes(number, tokens, places, k), return_inverse=True) if k > 1 else (number, tokens[places].astype(np.int64))
    else:
        follows = tokens[tokens != 0]
        prefixes, group = np.zeros(1, np.uint64), np.zeros(len(follows), np.int64)
    pairs, counts = np.unique(group * len(number) + follows, return_counts=True)
    if not len(pairs):
        return
    prefix, next_ = prefixes[pairs // len(number)], number[pairs % len(number)]
    split = np.full(len(prefixes), parts, np.uint64)
    if parts_of:
        for x in np.flatnonzero(np.isin(prefixes, np.array(list(parts_of), np.int64).astype(np.uint64))):
            split[x] = parts_of[int(prefixes[x].astype(np.int64))]
    bucket = ((prefix ^ (prefix >> np.uint64(29))) + next_ % split[pairs // len(number)] * FACTOR) % np.uint64(buckets)
    order = np.lexsort((next_, prefix, bucket))
    bucket, prefix, next_, counts = bucket[order].astype(np.int64), prefix[order].astype(np.int64), next_[order].astype(np.int64), counts[order].astype(np.int64)
    new = np.concatenate([[True], np.diff(bucket) != 0])
    starts = np.flatnonzero(new)
    heads = np.flatnonzero(new | np.concatenate([[True], np.diff(prefix) != 0]))
    ends, sizes = np.append(starts[1:], len(bucket)), np.diff(np.append(heads, len(bucket)))
    for at in range(0, len(starts), 256):
        a, b = starts[at : at + 256], ends[at : at + 256]
        lo, hi = np.searchsorted(heads, [a[0], b[-1]])
        of_head = pa.array(np.append(np.searchsorted(heads, a), hi) - lo, pa.int32())
        of_entry = pa.array(np.append(a, b[-1]) - a[0], pa.int32())
        lists = [pa.ListArray.from_arrays(o, pa.array(x)) for o, x in ((of_head, prefix[heads[lo:hi]]), (of_head, sizes[lo:hi]), (of_entry, next_[a[0] : b[-1]]), (of_entry, counts[a[0] : b[-1]]))]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(bucket[a]), pa.array(np.full(len(a), block)), *lists], [x.split()[0] for x in STRIPES.split(", ")])


def _stripes(k: int, buckets: int, parts: int):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield from stripes(r["block"], r["lang"], r["ids"], _unpack(r["tokens"]), dict(zip(r["hot"], r["parts"], strict=True)), k, buckets, parts)

    return run


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], np.diff(offsets)


def _lists(values: np.ndarray, row: np.ndarray, rows: int) -> pa.ListArray:
    """Values, sorted by row, as lists."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]), pa.int32()), pa.array(values))


def _add_up(table: pa.Table, group: np.ndarray, least: int):
    """Stripes of whole buckets, added up: the merged ones (block is null), then what each block is told of its own phrases."""
    prefix, stripes_ = _flat(table.column("prefix"))
    sizes, _ = _flat(table.column("size"))
    next_, _ = _flat(table.column("next"))
    n, _ = _flat(table.column("n"))
    row = np.repeat(np.repeat(np.arange(len(stripes_)), stripes_), sizes)
    prefix = np.repeat(prefix, sizes)
    order = np.lexsort((next_, prefix, group[row]))
    g, p, x, n = group[row][order], prefix[order], next_[order], n[order]
    same = (np.diff(g) == 0) & (np.diff(p) == 0)
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    starts = np.flatnonzero(np.concatenate([[True], ~same | (np.diff(x) != 0)]))
    f, total = np.add.reduceat(n, starts), np.add.reduceat(n, heads)
    often = (f >= least) & (x[starts] != 0)
    phrase = (p[starts].astype(np.uint64) * FACTOR + x[starts].astype(np.uint64)).astype(np.int64)
    of = (np.searchsorted(heads, starts, side="right") - 1)[often]
    names = [c.split()[0] for c in MERGED.split(", ")]
    lang = table.column("lang").combine_chunks()
    lists = [_lists(v[often], of, len(heads)) for v in (x[starts], f, phrase)]
    yield pa.RecordBatch.from_arrays([pa.nulls(len(heads), pa.int64()), lang.take(pa.array(row[order][heads])), pa.array(p[heads]), *lists, pa.array(total)], names)
    # a block meets each of its phrases once: it is told the count of those that are frequent
    counted, place = np.repeat(np.where(often, f, 0), np.diff(np.append(starts, len(order)))), np.repeat(phrase, np.diff(np.append(starts, len(order))))
    told = counted > 0
    if told.any():
        blocks = table.column("block").to_numpy()[row[order][told]]
        by = np.argsort(blocks, kind="stable")
        found, at = np.unique(blocks[by], return_inverse=True)
        none = lambda t: pa.nulls(len(found), t)
        yield pa.RecordBatch.from_arrays([pa.array(found), none(pa.string()), none(pa.int64()), none(pa.list_(pa.int64())), _lists(counted[told][by], at, len(found)), _lists(place[told][by], at, len(found)), none(pa.int64())], names)


def _merge(least: int):
    """Over stripes sorted by (lang, bucket): a bucket that goes on in the next batch waits for it."""

    def run(batches):
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            if not now.num_rows:
                continue
            held = now if held is None else pa.concat_tables([held, now]).combine_chunks()
            group = _groups(held)
            done = int(np.searchsorted(group, group[-1]))
            if done:
                yield from _add_up(held.slice(0, done), group[:done], least)
                held = held.slice(done)
        if held is not None:
            yield from _add_up(held, _groups(held), least)

    return run


def _groups(table: pa.Table) -> np.ndarray:
    """The number of each row's bucket."""
    lang = table.column("lang").combine_chunks().dictionary_encode()
    lang = (lang.combine_chunks() if isinstance(lang, pa.ChunkedArray) else lang).indices.to_numpy()
    return np.concatenate([[0], np.cumsum((np.diff(lang) != 0) | (np.diff(table.column("bucket").to_numpy()) != 0))])


def _prune(k: int, part: int):
    """Keeps of a block the runs in which every phrase of k words is frequent."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], _schema())
        b = left.to_pylist()[0]
        number, tokens = _numbers(b["ids"]), np.append(_unpack(b["tokens"]), np.zeros(1, np.int32))
        often, f = _flat(right.column("phrase"))[0].astype(np.uint64), _flat(right.column("f"))[0]
        places = runs(tokens, k)
        places = places[np.isin(hashes(number, tokens, places, k), often)]
        # consecutive places are a run, which ends k - 1 words after the last of them
        stop = np.append(np.diff(places) != 1, True) if len(places) else np.zeros(0, bool)
        lengths = np.where(stop, k + 1, 1)
        at = np.repeat(places, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        kept = tokens[np.minimum(at, len(tokens) - 1)]
        kept[np.cumsum(lengths)[stop] - 1] = 0
        used = np.unique(kept[kept != 0])
        renumbered = np.zeros(len(number), np.int32)
        renumbered[used] = np.arange(1, len(used) + 1)
        hot = f > part
        row = (b["block"], b["lang"], [], number[used].astype(np.int64), _pack(renumbered[kept]), often[hot].astype(np.int64), [sub_stripes(int(x), part) for x in f[hot]], int(len(places)))
        return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(row, _schema().types, strict=True)], schema=_schema())

    return run


def _schema() -> pa.Schema:
    whole = pa.list_(pa.int64())
    return pa.schema([("block", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.binary())), ("ids", whole), ("tokens", pa.binary()), ("hot", whole), ("parts", whole), ("n", pa.int64())])


def sub_stripes(occurrences: int, part: int) -> int:
    """1, 64, 4096, ...: so many that each has about so many occurrences."""
    parts = 1
    while parts * part < occurrences:
        parts *= SPLIT
    return parts


def merged_stripes(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, block: int = BLOCK, chunk: int = CHUNK, part: int = PART) -> tuple[DataFrame, list[DataFrame]]:
    """The words (lang, id, word) of the corpus, and the merged stripes of prefixes of 0 to longest - 1 words: lang, prefix (its
    hash, 0 for none), next, f and phrase (its hash; entries of least occurrences or more) and total."""
    small_batches(docs.sparkSession)
    given = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("text"))
    blocks = written(given.mapInArrow(_read(block, chunk), BLOCKS).withColumn("block", F.monotonically_increasing_id()), "blocks")
    names = written(blocks.select("lang", F.explode(F.arrays_zip("words", "ids")).alias("x")).select("lang", F.col("x.ids").alias("id"), F.col("x.words").cast("string").alias("word")).distinct(), "words")
    out = []
    for k in range(longest):
        places = blocks.agg(F.sum("n")).first()[0] or 0
        take = _stripes(k, -(-places // part) or 1, sub_stripes(places, part) if k == 0 else 1)
        mine = blocks.select("block", "lang", "ids", "tokens", "hot", "parts").mapInArrow(take, STRIPES)
        merged = written(mine.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket").mapInArrow(_merge(least), MERGED), "stripes")
        out.append(merged.where("block IS NULL").select("lang", "prefix", "next", "f", "phrase", "total"))
        if k + 1 < longest:
            told = merged.where("block IS NOT NULL").select("block", "phrase", "f")
            left = blocks.select("block", "lang", "ids", "tokens")
            pruned = left.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_prune(k + 1, part), "block long, " + BLOCKS)
            blocks = written(pruned, "blocks")
    return names, out


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, **sizes: int) -> DataFrame:
    """All candidates: lang, phrase, a, l, r, n, score, and subsumed, whether a longer candidate holds it as often. sizes: see merged_stripes()."""
    names, levels = merged_stripes(docs, least, longest, **sizes)
    totals = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))
    entries = lambda s: s.select("lang", "prefix", F.explode(F.arrays_zip("next", "f", "phrase")).alias("x")).select("lang", "prefix", F.col("x.next").alias("next"), F.col("x.f").alias("a"), F.col("x.phrase").alias("id"))
    words = names.join(entries(levels[0]).select("lang", "id", "a"), ["lang", "id"]).groupBy("lang", "id", "a").agg(F.min("word").alias("phrase"))
    none = F.array().cast("array<bigint>")
    before = words.select("lang", "id", F.array("id").alias("words"), "a", none.alias("pre"), none.alias("suf"), "phrase")
    found = None
    for k in range(1, longest):
        # the count of a prefix is its stripe's total
        own = levels[k].groupBy("lang", "prefix").agg(F.sum("total").alias("whole"), F.max(F.array_max("f")).alias("right"))
        two = entries(levels[k]).join(own.select("lang", "prefix", "whole"), ["lang", "prefix"])
        first = before.select("lang", F.col("id").alias("prefix"), F.col("words").alias("words0"), F.col("pre").alias("pre0"), F.col("phrase").alias("phrase0"))
        rest = before.select("lang", F.col("words").alias("rest"), F.col("a").alias("a1"), F.col("suf").alias("suf1"), F.col("phrase").alias("phrase1"))
        both = two.join(first, ["lang", "prefix"]).withColumn("words", F.concat("words0", F.array("next"))).withColumn("rest", F.slice("words", 2, k)).join(rest, ["lang", "rest"])
        now = both.select("lang", "id", "words", "a", F.concat("pre0", F.array("whole")).alias("pre"), F.concat(F.array("a1"), "suf1").alias("suf"), F.concat_ws(" ", "phrase0", F.substring_index("phrase1", " ", -1)).alias("phrase"))
        now = written(now, "candidates")
        if k > 1:
            left = now.groupBy("lang", F.slice("words", 2, k).alias("words")).agg(F.max("a").alias("left"))
            held = before.join(own.select("lang", F.col("prefix").alias("id"), "right"), ["lang", "id"], "left").join(left, ["lang", "words"], "left")
            judged = held.withColumn("most", F.coalesce(F.greatest("right", "left"), F.lit(0)))
            found = judged if found is None else found.unionByName(judged)
        before = now
    last = before.withColumn("right", F.lit(None).cast("long")).withColumn("left", F.lit(None).cast("long")).withColumn("most", F.lit(0).cast("long"))
    found = last if found is None else found.unionByName(last)
    exact = lambda c: F.col(c).cast("decimal(19,0)") if isinstance(c, str) else c.cast("decimal(19,0)")
    cut = lambda p, i: F.struct(score(exact("a"), exact("n"), exact(p), exact(F.get("suf", i))).alias("score"), (i + 1).alias("k"), p.alias("l"), F.get("suf", i).alias("r"))
    scored = found.join(totals, "lang").withColumn("cut", F.array_min(F.transform("pre", cut)))
    return scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"), (F.col("most") >= F.col("a")).alias("subsumed"))


def score(a, n, left, right):
    """floor(1000 a n / (left right)), exactly; all are decimals."""
    return F.call_function("div", a * n * F.lit(1000).cast("decimal(4,0)"), left * right)


def top_phrases(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first of each language: lang, rank, phrase, a, l, r, n, score."""
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.where(~F.col("subsumed")).withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> str:
    """The same in DuckDB's SQL, from all phrases of all lengths."""
    grams = " UNION ALL ".join(f"SELECT lang, ws[i : i + {m - 1}] AS w FROM placed WHERE i + {m - 1} <= len(ws)" for m in range(1, longest + 1))
    parts = " UNION ALL ".join(f"SELECT lang, w, a, w[1 : {k}] AS p, w[{k + 1} :] AS q, {k} AS k FROM c WHERE len(w) > {k}" for k in range(1, longest))
    return f"""
    WITH d AS (SELECT coalesce(lang, '{UNKNOWN}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    pieces AS (SELECT lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda x: x <> '') AS ws FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\n\\x0B\\x0C\\r]')) AS p FROM d)),
    placed AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
    f AS (SELECT lang, w, count(*) AS a FROM ({grams}) GROUP BY ALL),
    n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE len(w) = 1 GROUP BY lang),
    c AS (SELECT * FROM f WHERE len(w) > 1 AND a >= {least}),
    longer AS (SELECT lang, s, max(a) AS most FROM (SELECT lang, w[1 : -2] AS s, a FROM c UNION ALL SELECT lang, w[2 :] AS s, a FROM c) GROUP BY ALL),
    cuts AS (SELECT x.*, l.a AS l, r.a AS r, n.n, CAST((1000 * CAST(x.a AS HUGEINT) * n.n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
        FROM ({parts}) x JOIN f l ON l.lang = x.lang AND l.w = x.p JOIN f r ON r.lang = x.lang AND r.w = x.q JOIN n ON n.lang = x.lang),
    best AS (SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, k) AS o FROM cuts),
    kept AS (SELECT b.*, array_to_string(b.w, ' ') AS phrase FROM best b LEFT JOIN longer ON longer.lang = b.lang AND longer.s = b.w WHERE o = 1 AND coalesce(most, 0) < a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {top}
    """
