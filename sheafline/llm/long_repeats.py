"""Suffix-array deduplication of long repeats by bucket-pointer refinement, on buckets that Spark forms.

A string of LENGTH bytes that starts at two places or more of the corpus is a repeat, and every byte that one covers goes.

Bucket identifiers. A start's first bucket is that of its q-gram (q = 100). Buckets are refined by the identifiers at later
offsets, recursively: the pair at p and p + 100 names the bucket of 200 bytes, the pair of those at p and p + 200 the one
of 400. Identifiers are hashes of the pairs, so that a task can refine its own texts and only the sizes of buckets have to
be found by grouping. Starts in a bucket of size one drop out.

Keeping shuffles small. The least q-gram of each window of LENGTH bytes is its anchor; a run of starts with one anchor
(about 150 starts) is a row. Equal windows have equal anchors, so runs whose anchor's bucket has size one are done. Runs
equal as a whole, from their first window to their last, are repeats as a whole. The rest are looked at in aligned blocks of
STEP starts, and in single starts where a block is not decided: a block is a repeat as a whole if the string over all its
windows is in a bucket of two, and holds none if the string common to them is alone. One of each kind of decided run or block
goes along, as the partner of undecided ones.

Passages. The bytes that go are fixed by LENGTH, and 50 words are often fewer bytes than that. So a passage of PASSAGE words or
more (51, white space between them of any kind) that another document also holds is reported beside them, as spans of words; it
takes no bytes away. The same refinement finds it, with words in the place of bytes: buckets of 16, 32 and 51 words, anchors of 16
words, runs of windows with one anchor. A run equal as a whole to one of another document is decided, the rest are looked at window
by window, with two documents' runs of each decided kind as partners. A window's identifier is that of its anchor and its own.

Null texts count as empty. Matches never cross documents. Repeated rows repeat each other, and are other documents to
each other. Texts shorter than LENGTH have no repeats. Very long texts are cut into overlapping segments within a task. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TABLES, apart, remove_tables, texts, written

LENGTH, GRAM, STEP = 400, 100, 16
#: Words of the shortest passage reported, and of its anchor.
PASSAGE, ANCHOR = 51, 16
#: Bytes of a segment, and of the segments that are looked at together.
SEGMENT = 1 << 20
K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0x27D4EB2F165667C5)]


def _pair(a: np.ndarray, b: np.ndarray, k: int = 0) -> np.ndarray:
    """Identifier of a pair of identifiers, in order."""
    x = a * K[k]
    x += b * K[k + 1]
    x ^= x >> np.uint64(32)
    x *= K[3]
    return x


def identifiers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each start with enough bytes behind it: buckets of 100 and 200 bytes, and two independent ones of 400."""
    raw, n = data.tobytes(), len(data) - 7
    h = np.empty(n, np.uint64)  # the eight bytes at each start are their own bucket
    for i in range(min(8, n)):
        h[i::8] = np.frombuffer(raw, "<u8", len(h[i::8]), i)
    for size in (8, 16, 32):
        h = _pair(h[:-size], h[size:])
    h100 = _pair(h[: 64 - GRAM], h[GRAM - 64 :])
    h200 = _pair(h100[:-GRAM], h100[GRAM:])
    return h100, h200, _pair(h200[: -2 * GRAM], h200[2 * GRAM :]), _pair(h200[: -2 * GRAM], h200[2 * GRAM :], 1)


def segments(data: bytes):
    """(start, bytes) of overlapping segments; each window of LENGTH bytes starts in one of them alone."""
    if len(data) < LENGTH:
        return
    for at in range(0, len(data) - LENGTH + 1, SEGMENT):
        yield at, data[at : at + SEGMENT + LENGTH - 1]


def together(rows):
    """Segments of (key, text) rows, put together up to about SEGMENT bytes: (list of (key, start in the text, first, end), bytes)."""
    held, parts, size = [], [], 0
    for key, data in rows:
        for at, part in segments(data):
            held.append((key, at, size, size + len(part)))
            parts.append(part)
            size += len(part)
            if size >= SEGMENT:
                yield held, np.frombuffer(b"".join(parts), np.uint8)
                held, parts, size = [], [], 0
    if held:
        yield held, np.frombuffer(b"".join(parts), np.uint8)


def _anchors(grams: np.ndarray, span: int = LENGTH - GRAM + 1) -> np.ndarray:
    """For each window the place of its least q-gram, the first of equal ones; a window holds as many as span says."""
    v = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while 2 * size <= span:
        v = np.minimum(v[: len(v) - size], v[size:])
        size *= 2
    v = np.minimum(v[: len(v) - (span - size)], v[span - size :])
    return (v & np.uint64(0xFFFFFF)).astype(np.int64)


def _run_ends(held: list[tuple], anchor: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each run with one anchor in one text, and the text's number among those held."""
    valid, owner = np.zeros(len(anchor), bool), np.zeros(len(anchor), np.int64)
    for n, (_, _, lo, hi) in enumerate(held):
        valid[lo : max(lo, hi - length + 1)] = True
        owner[lo:hi] = n
    starts = np.flatnonzero(valid)
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) > 1) | (np.diff(anchor[starts]) != 0) | (np.diff(owner[starts]) != 0)
    s = starts[new]
    return s, np.concatenate([starts[np.flatnonzero(new)[1:] - 1], starts[-1:]]), owner[s]


RUNS = "key long, doc long, first int, width int, lead int, gram long, a long, b long"


def _runs(batches):
    names = [x.split()[0] for x in RUNS.split(", ")]
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for held, data in together((k, t.as_py().encode()) for k, t in zip(keys, batch.column(2), strict=True)):
            h100, _, ha, hb = identifiers(data)
            anchor = _anchors(h100)
            s, e, own = _run_ends(held, anchor, LENGTH)
            if not len(s):
                continue
            at = anchor[s]
            shift = np.array([a - lo for _, a, lo, _ in held], np.int64)[own]
            width = (e - s).astype(np.uint64)
            cols = [
                np.array([k[0] for k, *_ in held], np.int64)[own], np.array([k[1] for k, *_ in held], np.int64)[own], (s + shift).astype(np.int32), (e - s).astype(np.int32),
                (at - s).astype(np.int32), h100[at].view(np.int64), (_pair(ha[s], ha[e] + width)).view(np.int64), (_pair(hb[s], hb[e] + width, 1)).view(np.int64),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)


BLOCKS = "key long, doc long, first int, n int, sure boolean, core long, a long, b long"
SINGLES = "key long, doc long, first int, sure boolean, a long, b long"


def _lists(column) -> list[dict[str, np.ndarray]]:
    """The arrays of a column of lists of structs, row by row."""
    at, inner = column.offsets.to_numpy(), column.values
    fields = {f.name: inner.field(k).to_numpy(zero_copy_only=False) for k, f in enumerate(inner.type)}
    return [{n: v[i:j] for n, v in fields.items()} for i, j in zip(at[:-1], at[1:], strict=True)]


def _stretches(first: np.ndarray, last: np.ndarray):
    """Slices of sorted runs that lie within about SEGMENT bytes together."""
    lo = 0
    for k in range(1, len(first) + 1):
        if k == len(first) or last[k] - first[lo] > SEGMENT:
            yield slice(lo, k)
            lo = k


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of so many parts: the row it belongs to and its number within the row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _rows(found: list[tuple], types: list, names: list[str]):
    cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c).cast(t) for c, t in zip(cols, types, strict=True)], names)


def _block_rows(batches):
    """Aligned blocks of the undecided runs of each text, and of decided runs that are to be partners."""
    names, types = [x.split()[0] for x in BLOCKS.split(", ")], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        found = []
        for key, doc, text, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), _lists(batch.column(3)), strict=True):
            data = np.frombuffer(text.as_py().encode(), np.uint8)
            order = np.unique(runs["first"], return_index=True)[1]
            first, width, lead, sure = (runs[n][order].astype(np.int64) for n in ("first", "width", "lead", "sure"))
            for part in _stretches(first, first + width):
                s, w, anchor, known = first[part], width[part], first[part] + lead[part], sure[part]
                lo = max(0, int(s[0]) - STEP)
                h100, h200, ha, hb = identifiers(data[lo : int((s + w).max()) + LENGTH + STEP])
                low, high = (s - anchor) // STEP, (s + w - anchor) // STEP
                row, k = _spread(high - low + 1)
                b = anchor[row] + (low[row] + k) * STEP
                at, end = np.maximum(b, s[row]), np.minimum(b + STEP, s[row] + w[row] + 1)
                whole = end - at == STEP
                # common to the windows of the aligned block: LENGTH - STEP + 1 bytes from its last start on
                x = b + STEP - 1 - lo
                core = _pair(h200[x], h200[x + LENGTH - STEP + 1 - 2 * GRAM], 2)
                y = np.where(whole, b - lo, 0)
                z = np.where(whole, y + STEP - 1, 0)
                a, c = _pair(ha[y], ha[z], 2), _pair(hb[y], hb[z])
                a[~whole], c[~whole] = 0, 0
                found.append((np.full(len(b), key), np.full(len(b), doc), at, end - at, known[row].astype(bool), core, a, c))
        yield _rows(found, types, names)


def _single_rows(batches):
    names, types = [x.split()[0] for x in SINGLES.split(", ")], [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
    for batch in batches:
        found = []
        for key, doc, text, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), _lists(batch.column(3)), strict=True):
            data = np.frombuffer(text.as_py().encode(), np.uint8)
            order = np.unique(blocks["first"], return_index=True)[1]
            first, n, sure = (blocks[c][order].astype(np.int64) for c in ("first", "n", "sure"))
            for part in _stretches(first, first + n):
                lo = int(first[part][0])
                _, _, ha, hb = identifiers(data[lo : int((first[part] + n[part]).max()) - 1 + LENGTH])
                row, k = _spread(n[part])
                at = first[part][row] + k
                found.append((np.full(len(at), key), np.full(len(at), doc), at, sure[part][row].astype(bool), ha[at - lo], hb[at - lo]))
        yield _rows(found, types, names)


SPACES, SPACE_AT = re.compile(rb"[\x20\x09-\x0D]"), np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: What is left of eight bytes if a word holds so many of them.
MASKS = np.array([2 ** (8 * n) - 1 for n in range(9)], np.uint64)


def words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the words of a text, from their bytes by eights, and their starts."""
    edges = np.flatnonzero(np.diff(SPACE_AT[np.frombuffer(data, np.uint8)], prepend=True, append=True))
    s, e = edges[::2], edges[1::2]
    if not len(s):
        return np.zeros(0, np.uint64), s
    counts = (e - s + 7) // 8
    row, k = _spread(counts)
    at = s[row] + 8 * k
    n = np.minimum(8, e[row] - at)
    eights = np.ndarray(len(data), "<u8", data + bytes(8), 0, (1,))[at] & MASKS[n]
    return np.add.reduceat(_pair(eights, (8 * k + n).astype(np.uint64), 2), np.cumsum(counts) - counts), s


def _all_words(data: bytes) -> np.ndarray:
    """Identifiers of the words of a text of any length, taken in parts that end at white space."""
    found, at = [np.zeros(0, np.uint64)], 0
    while at < len(data):
        space = SPACES.search(data, at + SEGMENT)
        end = space.start() if space else len(data)
        found.append(words(data[at:end])[0])
        at = end
    return np.concatenate(found)


def _words_together(rows):
    """Words of (key, text) rows, put together up to about SEGMENT bytes: (list of (key, first word in the text, first, end), identifiers)."""

    def flushed():
        ids, starts = words(b" ".join(parts))
        ends = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in parts])).tolist()
        return [(key, 0, lo, hi) for key, lo, hi in zip(held, [0, *ends], ends, strict=False)], ids

    held, parts, size = [], [], 0
    for key, data in rows:
        if len(data) > SEGMENT:
            ids = _all_words(data)
            for at in range(0, len(ids) - PASSAGE + 1, SEGMENT):
                part = ids[at : at + SEGMENT + PASSAGE - 1]
                yield [(key, at, 0, len(part))], part
        elif len(data) >= 2 * PASSAGE - 1:
            held.append(key)
            parts.append(data)
            size += len(data)
            if size >= SEGMENT:
                yield flushed()
                held, parts, size = [], [], 0
    if held:
        yield flushed()


def passage_identifiers(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word with enough words behind it: buckets of ANCHOR and of PASSAGE words."""
    for size in (1, 2, 4, 8):
        ids = _pair(ids[:-size], ids[size:])
    twice = _pair(ids[:-ANCHOR], ids[ANCHOR:])
    return ids, _pair(twice[: 2 * ANCHOR - PASSAGE], twice[PASSAGE - 2 * ANCHOR :])


PASSAGE_RUNS = "row long, key long, doc long, first int, width int, gram long, a long"
WINDOWS = "key long, doc long, first int, gram long, a long"
PASSAGES = "key long, doc long, n_shared_words long, passages array<struct<start:int,end:int>>"


def _passage_runs(batches):
    names = [x.split()[0] for x in PASSAGE_RUNS.split(", ")]
    for batch in batches:
        ids_of = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
        for held, ids in _words_together((k, t.as_py().encode()) for k, t in zip(ids_of, batch.column(3), strict=True)):
            if len(ids) < PASSAGE:
                continue
            grams, whole = passage_identifiers(ids)
            anchor = _anchors(grams, PASSAGE - ANCHOR + 1)
            s, e, own = _run_ends(held, anchor, PASSAGE)
            if not len(s):
                continue
            shift = np.array([a - lo for _, a, lo, _ in held], np.int64)[own]
            keys = [np.array([k[i] for k, *_ in held], np.int64)[own] for i in range(3)]
            a = _pair(whole[s], whole[e] + (e - s).astype(np.uint64))
            cols = [*keys, (s + shift).astype(np.int32), (e - s).astype(np.int32), grams[anchor[s]].view(np.int64), a.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)


def _windows(batches):
    """Every window of the given runs of each text."""
    names, types = [x.split()[0] for x in WINDOWS.split(", ")], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    for batch in batches:
        found = []
        for key, doc, text, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), _lists(batch.column(3)), strict=True):
            ids = _all_words(text.as_py().encode())
            order = np.unique(runs["first"], return_index=True)[1]
            first, width, gram = (runs[n][order].astype(np.int64) for n in ("first", "width", "gram"))
            for part in _stretches(first, first + width):
                lo = int(first[part][0])
                whole = passage_identifiers(ids[lo : int((first + width)[part].max()) + PASSAGE])[1]
                row, k = _spread(width[part] + 1)
                at = first[part][row] + k
                found.append((np.full(len(at), key), np.full(len(at), doc), at, gram[part][row], whole[at - lo]))
        yield _rows(found, types, names)


def _joined(batches):
    """Spans of words of each text, those that meet made one."""
    names, span = [x.split()[0] for x in PASSAGES.split(", ")], pa.struct([("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        total, spans = [], []
        for given in _lists(batch.column(2)):
            order = np.argsort(given["start"], kind="stable")
            start, end = given["start"][order], np.maximum.accumulate(given["end"][order])
            new = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
            first, last = start[new], end[np.append(new[1:], len(end)) - 1]
            total.append(int((last - first).sum()))
            spans.append([{"start": x, "end": y} for x, y in zip(first.tolist(), last.tolist(), strict=True)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(total, pa.int64()), pa.array(spans, pa.list_(span))], names)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


CUT = "key long, doc long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>"


def _cut(batches):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            data = row["text"].encode()
            gone = merged([(x["start"], x["end"]) for x in row["spans"]])
            kept, at = [], 0
            for s, e in gone:
                kept.append(data[at:s])
                at = e
            kept.append(data[at:])
            rows.append((row["key"], row["doc"], sum(e - s for s, e in gone), len(gone), hashlib.sha256(b"".join(kept)).hexdigest(), [{"start": s, "end": e} for s, e in gone]))
        cols = list(zip(*rows, strict=True)) or [()] * 6
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(span)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [x.split()[0] for x in CUT.split(", ")])


def _keyed(docs: DataFrame) -> DataFrame:
    """key (a hash of id and text) and doc (the id, the least long for a null) name a document together."""
    given = texts(docs)
    return given.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.coalesce("doc_id", F.lit(-(2**63))).alias("doc"), "text")


def _twice(df: DataFrame, *by: str) -> DataFrame:
    """The values that occur twice or more, counted before the shuffle."""
    return df.groupBy(*by).agg(F.count("*").alias("times")).where("times > 1").drop("times")


def _shared(df: DataFrame, who: str, *by: str) -> DataFrame:
    """The values that two rows or documents have, counted before the shuffle."""
    return df.groupBy(*by).agg(F.min(who).alias("least"), F.max(who).alias("most")).where("least <> most").drop("least", "most")


def _decided_passages(keyed: DataFrame) -> DataFrame:
    """The runs whose anchor another document holds too; sure, if it holds the run."""
    rows = keyed.select(F.monotonically_increasing_id().alias("row"), "key", "doc", "text")  # tells repeated rows apart; written at once
    spark, since = keyed.sparkSession, len(TABLES)
    runs = written(rows.mapInArrow(_passage_runs, PASSAGE_RUNS), "passage-runs")
    live = written(runs.join(apart(_shared(runs, "row", "gram")), "gram", "left_semi"), "live-passages")
    remove_tables(spark, since)
    same = _shared(live, "row", "gram", "a").withColumn("sure", F.lit(True))
    decided = written(live.drop("row").join(apart(same), ["gram", "a"], "left").withColumn("sure", F.coalesce("sure", F.lit(False))), "decided-passages")
    remove_tables(spark, since)
    return decided


def _open_passages(decided: DataFrame) -> DataFrame:
    """Undecided runs, and for each kind of decided ones with the same anchor those of two documents, by document."""
    open_ = decided.where("NOT sure")
    run, order = F.struct("key", "doc", "first", "width", "gram"), F.struct("key", "doc", "first")
    # one row for each kind before the join, so that a common passage is counted where it is read
    kinds = decided.where("sure").groupBy("gram", "a").agg(F.array(F.min_by(run, order), F.max_by(run, order)).alias("x"))
    partners = kinds.join(apart(open_.select("gram").distinct()), "gram", "left_semi").select(F.explode("x").alias("x")).select("x.*")
    both = open_.select("key", "doc", "first", "width", "gram").unionByName(partners)
    return both.groupBy("key", "doc").agg(F.collect_list(F.struct("first", "width", "gram")).alias("runs"))


def _passages(bodies: DataFrame, decided: DataFrame, per_doc: DataFrame) -> DataFrame:
    """key, doc, n_shared_words and passages of the documents that share any."""
    windows = written(bodies.join(per_doc, ["key", "doc"]).mapInArrow(_windows, WINDOWS), "windows")
    hits = windows.join(apart(_shared(windows, "key", "gram", "a")), ["gram", "a"], "left_semi")
    span = lambda df, end: df.select("key", "doc", F.col("first").alias("start"), F.expr(end).alias("end"))
    found = span(decided.where("sure"), f"first + width + {PASSAGE}").unionByName(span(hits, f"first + {PASSAGE}"))
    return found.groupBy("key", "doc").agg(F.collect_list(F.struct("start", "end")).alias("spans")).mapInArrow(_joined, PASSAGES)


def long_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept (bytes left), repeats (whether any went), n_shared_words (words in
    passages of PASSAGE words or more that another document also holds), the removed spans (bytes) and the passages (words, from 0) of each document."""
    keyed = _keyed(docs)
    alike = _decided_passages(keyed)
    alike_per_doc = written(_open_passages(alike), "open-passages")
    spark, since = docs.sparkSession, len(TABLES)
    runs = written(keyed.select("key", "doc", "text").mapInArrow(_runs, RUNS), "runs")
    live = written(runs.join(apart(_twice(runs, "gram")), "gram", "left_semi"), "live-runs")
    remove_tables(spark, since)
    same = _twice(live, "a", "b").withColumn("sure", F.lit(True))
    decided = written(live.join(apart(same), ["a", "b"], "left").withColumn("sure", F.coalesce("sure", F.lit(False))), "decided-runs")
    remove_tables(spark, since)
    open_ = decided.where("NOT sure")
    # one run of each kind that is decided, where an undecided one has the same anchor bucket
    partners = decided.where("sure").join(apart(open_.select("gram").distinct()), "gram", "left_semi").groupBy("a", "b").agg(F.min_by(F.struct("key", "doc", "first", "width", "lead", "sure"), F.struct("key", "doc", "first")).alias("x")).select("x.*")
    wanted = open_.select("key", "doc", "first", "width", "lead", "sure").unionByName(partners)
    per_doc = wanted.groupBy("key", "doc").agg(F.collect_list(F.struct("first", "width", "lead", "sure")).alias("runs"))
    touched = decided.select("key", "doc").unionByName(alike_per_doc.select("key", "doc")).distinct()
    bodies = written(keyed.select("key", "doc", "text").join(touched, ["key", "doc"], "left_semi").dropDuplicates(["key", "doc"]), "touched")
    since = len(TABLES)
    blocks = written(bodies.join(per_doc, ["key", "doc"]).mapInArrow(_block_rows, BLOCKS), "blocks")
    whole = _twice(blocks.where("a <> 0 OR b <> 0"), "a", "b").withColumn("full", F.lit(True))
    judged = written(blocks.join(apart(_twice(blocks, "core")), "core", "left_semi").join(apart(whole), ["a", "b"], "left").withColumn("full", F.coalesce("full", F.lit(False))), "judged-blocks")
    remove_tables(spark, since)
    undecided = judged.where("NOT full")
    with_ = judged.where("full").join(apart(undecided.select("core").distinct()), "core", "left_semi").groupBy("a", "b").agg(F.min_by(F.struct("key", "doc", "first", "n"), F.struct("key", "doc", "first")).alias("x")).select("x.*", F.lit(True).alias("sure"))
    singles = undecided.select("key", "doc", "first", "n", "sure").unionByName(with_)
    per_doc = singles.groupBy("key", "doc").agg(F.collect_list(F.struct("first", "n", "sure")).alias("blocks"))
    ones = written(bodies.join(per_doc, ["key", "doc"]).mapInArrow(_single_rows, SINGLES), "single-starts")
    hits = ones.join(apart(_twice(ones, "a", "b")), ["a", "b"], "left_semi")
    span = lambda df, end: df.select("key", "doc", F.col("first").alias("start"), F.expr(end).alias("end"))
    gone = span(decided.where("sure"), f"first + width + {LENGTH}")
    gone = gone.unionByName(span(judged.where("full"), f"first + n - 1 + {LENGTH}")).unionByName(span(hits, f"first + {LENGTH}"))
    spans = gone.groupBy("key", "doc").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    cut = bodies.join(spans, ["key", "doc"]).mapInArrow(_cut, CUT)
    every = keyed.select("doc_id", "key", "doc", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    out = every.join(cut, ["key", "doc"], "left").join(_passages(bodies, alike, alike_per_doc), ["key", "doc"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", "n_bytes", zero("n_removed"), zero("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), (F.col("n_bytes") - F.coalesce("n_removed", F.lit(0))).alias("n_kept"), (F.coalesce("n_removed", F.lit(0)) > 0).alias("repeats"), zero("n_shared_words"), "spans", "passages")
