"""Best-fit packing of documents into sequences by bin completion over the histogram of lengths.

A document's tokens and an end mark are one piece; longer ones are cut so that all pieces but the first fill a sequence. Lengths are
whole numbers up to the capacity, so the counts of pieces by length say all that a packing needs, whatever the number of
documents, and a packing is a list of patterns (so many pieces of each length) with the number of sequences of each.

The search: best-fit decreasing gives the first incumbent. Then branch and bound: the longest piece left must be in some sequence,
so its node branches over the undominated fillings of the room beside it (none of whose pieces could give way to a longer one, or
several to one as long as they together), the least waste first and then that which the counts allow most often, and takes it
so often. A node looks at FILLINGS fillings and keeps BRANCHES. A branch ends once the sequences so far and the tokens left cannot give less than the incumbent, and the search
once the incumbent reaches the lower bound, or after NODES nodes: then the best packing found stands, which holds every piece.

Within each length pieces are numbered over the cluster: a task numbers its own, and the counts by task and length, summed up over
tasks, tell where each task starts. A piece's number falls into one pattern's range, which says its sequence and place. Through
the driver go one count for each length, and broadcast is the list of patterns, of which there are a few for each length.

Ids are those of the tokenizers library, of whose vocabulary file the merge ranks are read; texts are encoded by tiktoken from
these ranks, which gives the same ids about four times as fast, and texts with a very long run of letters or spaces by
tokenizers itself. Strings of special tokens in a text are ordinary text. A null text is an empty one: its piece holds the end
mark alone. Repeated rows are packed as often as they are there. Empty tables give an empty result; other columns are left out.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import _tokenizer, byte_table, vocabulary_path
from .common import texts, written

CAPACITY, END, NODES, BRANCHES, FILLINGS, TESTED = 1024, 2, 6000, 8, 64, 10
#: Runs that tiktoken's matcher could stumble over; they are left to tokenizers.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")

#: Pieces of one length in a pattern, and a pattern with the number of sequences that it fills.
Fill = tuple[tuple[int, int], ...]
Pattern = tuple[int, Fill]


@lru_cache(maxsize=2)
def _ranks(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in enumerate(byte_table(path))}, special_tokens={})


def encode(text: str, path: str) -> np.ndarray:
    if LONG_RUN.search(text):
        return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, np.uint32)
    return _ranks(path).encode_to_numpy(text, disallowed_special=())


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing: each piece into the fullest sequence that has room; all pieces of a length and alike sequences in one step."""
    rooms: list[int] = []  # sorted
    open_: dict[int, list[list]] = {}  # room: [sequences, fill]

    def put(n: int, room: int, fill: Fill) -> None:
        if n:
            if room not in open_:
                rooms.insert(bisect_left(rooms, room), room)
            open_.setdefault(room, []).append([n, fill])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            room = rooms[at] if at < len(rooms) else capacity
            n, fill = open_[room].pop() if at < len(rooms) else (math.inf, ())
            if at < len(rooms) and not open_[room]:
                del open_[room], rooms[at]
            each = room // size
            full = int(min(n, left // each))
            put(full, room - each * size, (*fill, (size, each)))
            left -= full * each
            if n > full and left < each:
                if left:
                    put(1, room - left * size, (*fill, (size, left)))
                    n, left = n - 1, 0
            if n > full and n < math.inf:
                put(int(n - full), room, fill)
    return [(n, fill) for held in open_.values() for n, fill in held]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: pieces over capacity - t stand alone, those over half of it cannot be paired, and the room that
    they leave for pieces of t and more is bounded; the best of all t."""
    sizes = np.arange(capacity + 1)
    n = np.zeros(capacity + 1, np.int64)
    for s, c in counts.items():
        n[s] = c
    number, tokens = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * sizes)])
    best = -(-int(tokens[-1]) // capacity)
    between = lambda x, lo, hi: int(x[hi + 1] - x[lo]) if hi >= lo else 0
    for t in range(capacity // 2 + 1):
        alone, large = between(number, capacity - t + 1, capacity), between(number, capacity // 2 + 1, capacity - t)
        room = large * capacity - between(tokens, capacity // 2 + 1, capacity - t)
        small = between(tokens, t, capacity // 2)
        best = max(best, alone + large + max(0, -(-(small - room) // capacity)))
    return best


def fillings(counts: dict[int, int], room: int, most_waste: int) -> Iterator[tuple[int, Fill]]:
    """Waste and pieces of the fillings of a room by the pieces at hand, the least waste first, then the longest pieces first."""
    sizes = sorted((s for s, c in counts.items() if c and s <= room), reverse=True)
    mask, reach = (1 << (room + 1)) - 1, [1]  # sums that the sizes from each on can make, as bits
    for s in reversed(sizes):
        bits, left, step = reach[-1], min(counts[s], room // s), 1
        while left:
            take = min(step, left)
            bits |= (bits << (take * s)) & mask
            left, step = left - take, 2 * step
        reach.append(bits)
    reach.reverse()

    def exact(i: int, t: int) -> Iterator[Fill]:
        if not t:
            yield ()
            return
        while i < len(sizes) and reach[i] >> t & 1:
            s = sizes[i]
            for j in range(min(counts[s], t // s), 0, -1):
                if reach[i + 1] >> (t - j * s) & 1:
                    for rest in exact(i + 1, t - j * s):
                        yield ((s, j), *rest)
            i += 1

    for waste in range(min(most_waste, room) + 1):
        if reach[0] >> (room - waste) & 1:
            yield from ((waste, fill) for fill in exact(0, room - waste))


def dominated(fill: Fill, counts: dict[int, int], waste: int) -> bool:
    """Whether a piece that is left could stand for some of the filling's and waste no more: a longer one, or one for several. Fillings of
    more than TESTED pieces are not tested."""
    if sum(j for _, j in fill) > TESTED:
        return False
    held = dict(fill)
    sums = {(0, 0)}
    for s, j in fill:
        sums |= {(t + i * s, min(2, n + i)) for t, n in sums for i in range(1, j + 1)}
    for t, n in sums:
        for y in range(t + (n < 2), t + waste + 1) if n else ():
            if counts.get(y, 0) > held.get(y, 0):
                return True
    # without any piece in it, a filling gives way to every piece that has room
    return not fill and any(c and s <= waste for s, c in counts.items())


def complete(counts: dict[int, int], capacity: int, nodes: int = NODES, branches: int = BRANCHES) -> list[Pattern]:
    """The best packing found: best-fit decreasing, then bin completion, depth first, until the lower bound or so many nodes."""
    counts = {s: c for s, c in counts.items() if c}
    best = best_fit(counts, capacity)
    fewest, least = sum(n for n, _ in best), lower_bound(counts, capacity)
    left, tokens, used = dict(counts), sum(s * c for s, c in counts.items()), 0
    order = sorted(counts, reverse=True)

    def branch(at: int) -> tuple:
        size = order[at]
        left[size] -= 1
        spare = (fewest - 1) * capacity - used * capacity - tokens
        found = [x for x in islice(fillings(left, capacity - size, spare), FILLINGS) if not dominated(x[1], left, x[0])] if spare >= 0 else []
        # of equal waste, that which can be taken most often
        found.sort(key=lambda x: (x[0], -min([left[s] // j for s, j in x[1]], default=0), len(x[1])))
        left[size] += 1
        return at, iter([f for _, f in found[:branches]])

    def first(at: int) -> int:
        while at < len(order) and not left[order[at]]:
            at += 1
        return at

    stack, taken = ([branch(0)] if order and fewest > least else []), []
    while stack and nodes > 0 and fewest > least:
        nodes -= 1
        at, todo = stack[-1]
        if len(taken) == len(stack):  # back from below: undo this node's last filling
            n, fill = taken.pop()
            used -= n
            for s, j in fill:
                left[s] += n * j
                tokens += n * j * s
        fill = next(todo, None)
        if fill is None:
            stack.pop()
            continue
        size = order[at]
        fill = ((size, 1 + dict(fill).get(size, 0)), *(x for x in fill if x[0] != size))
        n = min(left[s] // j for s, j in fill)
        used += n
        for s, j in fill:
            left[s] -= n * j
            tokens -= n * j * s
        taken.append((n, fill))
        below = first(at)
        if below == len(order):
            if used < fewest:
                best, fewest = list(taken), used
        elif used - (-tokens // capacity) < fewest:
            stack.append(branch(below))
    return best


class Plan:
    """Patterns as ranges of the pieces' numbers within their length."""

    def __init__(self, patterns: list[Pattern], capacity: int):
        self.shift = 62 - capacity.bit_length()
        rows, taken, base = [], {}, 0
        for n, fill in sorted(patterns, key=lambda p: p[1], reverse=True):
            offset = 0
            for s, j in fill:
                rows.append(((s << self.shift) + taken.get(s, 0), base, j, offset, s))
                taken[s] = taken.get(s, 0) + n * j
                offset += s * j
            base += n
        self.sequences = base
        self.start, self.base, self.each, self.offset, self.size = np.array(sorted(rows), np.int64).reshape(-1, 5).T

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these lengths and numbers."""
        key = (length << self.shift) + number
        at = np.searchsorted(self.start, key, side="right") - 1
        nth = key - self.start[at]
        return self.base[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * self.size[at]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, path: str | None = None, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (or ids, if asked for), k (the number within the task and length) and the task."""
    path = path or vocabulary_path()

    def run(batches):
        seen = np.zeros(capacity + 1, np.int64).tolist()
        for batch in batches:
            rows = []
            for doc, text_ in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text_.as_py(), path), np.uint32(end)).astype("<u4")
                at, stop = 0, (len(ids) - 1) % capacity + 1
                number = 0
                while at < len(ids):
                    n = stop - at
                    held = ids[at:stop]
                    rows.append((doc, number, at, n, held if with_ids else zlib.crc32(held.tobytes()), seen[n]))
                    seen[n] += 1
                    at, stop, number = stop, stop + capacity, number + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()) if with_ids else pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 6, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids", "k"])

    kind = "ids array<int>" if with_ids else "ids long"
    found = texts(docs, doc_id, text).mapInArrow(run, f"doc_id long, piece int, start long, length long, {kind}, k long")
    return (found if with_ids else found.withColumnRenamed("ids", "ids_crc32")).withColumn("task", F.spark_partition_id())


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = END, path: str | None = None, with_ids: bool = False, nodes: int = NODES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (or the ids, if asked for), sequence_id and offset of every piece."""
    given = written(pieces(docs, capacity, end, path, with_ids, doc_id, text), "pieces")
    counts = written(given.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    # a row for each length
    plan = Plan(complete({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity, nodes), capacity)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("sequence_id", "offset"), plan.place(length.to_numpy(np.int64), number.to_numpy(np.int64)), strict=True)))

    numbered = given.join(counts.select("task", "length", before.alias("before")), ["task", "length"])
    own = "ids" if with_ids else "ids_crc32"
    return numbered.withColumn("at", place("length", F.col("before") + F.col("k"))).select("doc_id", "piece", "start", "length", own, "at.sequence_id", "at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, and the pieces in it (doc_id, piece, offset, length), in order, of a packing with ids. A sequence is bounded by the capacity."""
    piece = F.struct("offset", "doc_id", "piece", "length", "ids")
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("x"))
    return held.select("sequence_id", F.flatten("x.ids").alias("ids"), F.transform("x", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["offset"].alias("offset"), p["length"].alias("length"))).alias("pieces"))
