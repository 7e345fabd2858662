"""Scalar functions on sequences and alignment strings, as column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def gc_percent(seq: Column) -> Column:
    """G and C over the whole length, ambiguous letters included; 2 decimals, null for an empty sequence."""
    n = F.length(seq)
    return F.when(n > 0, F.round(100.0 * (n - F.length(F.translate(seq, "GC", ""))) / n, 2))


def gc_weighted(seq: Column) -> Column:
    """GC equivalents: each ambiguity code counts by its share of G and C."""
    # Sixths of G or C in the codes.
    weights = {6: "GCS", 4: "BV", 3: "RYKMN", 2: "DH"}
    out = F.lit(0)
    for w, codes in weights.items():
        out = out + w * (F.length(seq) - F.length(F.translate(seq, codes, "")))
    return out / 6


def aligned_bases(cigar: Column, kinds: str = "M=X") -> Column:
    """Sum of the lengths of the given operations of a CIGAR string."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{kinds}]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def kmer_counts(k: int):
    """A vectorised function that counts k-mers on both strands, 4^k cells; windows with other letters count nothing."""
    code = np.full(256, -1, np.int64)
    code[[ord(c) for c in "ACGT"]] = range(4)
    every = np.arange(4**k)
    turned = np.zeros(4**k, np.int64)  # the reverse complement of each k-mer
    for i in range(k):
        turned = turned * 4 + 3 - every // 4**i % 4

    @F.pandas_udf("array<long>")
    def count(seqs: pd.Series) -> pd.Series:
        def one(s):
            if s is None:
                return None
            x = code[np.frombuffer(s.encode(), np.uint8)]
            n = len(x) - k + 1
            if n <= 0:
                return np.zeros(4**k, np.int64)
            value, bad = np.zeros(n, np.int64), np.zeros(n, bool)
            for i in range(k):
                value = value * 4 + x[i : i + n]
                bad |= x[i : i + n] < 0
            ahead = np.bincount(value[~bad], minlength=4**k)
            return ahead + ahead[turned]

        return seqs.map(one)

    return count


def canonical_kmers(counts: list[int] | np.ndarray, k: int) -> np.ndarray:
    """Counts of both strands, one cell for a k-mer and its reverse complement (136 for k = 4), in the order of the smaller code."""
    every = np.arange(4**k)
    turned = np.zeros(4**k, np.int64)
    for i in range(k):
        turned = turned * 4 + 3 - every // 4**i % 4
    return np.asarray(counts)[every <= turned]


def kmer_frequencies(k: int = 4):
    """A vectorised function: shares of the canonical k-mers; null for sequences without any."""
    inner = kmer_counts(k).func

    @F.pandas_udf("array<double>")
    def share(seqs: pd.Series) -> pd.Series:
        def one(c):
            x = canonical_kmers(c, k).astype(float)
            return x / x.sum() if x.sum() else None

        return inner(seqs).map(lambda c: None if c is None else one(c))

    return share


def longest_border(data: bytes, limit: int) -> int:
    """The longest n up to a limit for which the first n bytes are the last n.

    Prefix sums of the bytes times powers of an odd number give every prefix and suffix a hash at once; the lengths at which
    they agree are compared from the longest on.
    """
    n = len(data)
    if limit <= 0:
        return 0
    with np.errstate(over="ignore"):
        power = np.ones(limit + 1, np.uint64)
        power[1:] = np.cumprod(np.full(limit, 0x9E3779B97F4A7C15, np.uint64))

        def sums(start):
            out = np.zeros(limit + 1, np.uint64)
            out[1:] = np.cumsum((np.frombuffer(data, np.uint8, limit, start).astype(np.uint64) + np.uint64(1)) * power[:limit])
            return out

        head, tail = sums(0), sums(n - limit)
        sizes = np.arange(limit, 0, -1)
        # the last k bytes start at limit - k in the tail: their sum is shifted by that power
        agree = head[sizes] * power[limit - sizes] == tail[limit] - tail[limit - sizes]
    return next((int(k) for k in sizes[agree] if data[:k] == data[n - k :]), 0)


def terminal_overlap(least: int = 30, most: int = 10_000):
    """A vectorised function: the longest suffix that is a prefix, up to a fifth of the length; 0 if it is short or has other letters than ACGT."""

    @F.pandas_udf("long")
    def overlap(seqs: pd.Series) -> pd.Series:
        def one(s):
            if s is None:
                return None
            data = s.encode()
            n = longest_border(data, min(most, len(data) // 5))
            return n if n >= least and not data[:n].strip(b"ACGT") and set(data[:n]) <= set(b"ACGT") else 0

        return seqs.map(one)

    return overlap


def human_bp(n: Column) -> Column:
    """1234567 as 1.23 Mb; halves go to the even digit."""
    shown = lambda unit, places, name: F.format_string(f"%.{places}f {name}", F.bround(n / unit, places))
    return F.when(n >= 1_000_000, shown(1e6, 2, "Mb")).when(n >= 1000, shown(1e3, 1, "kb")).otherwise(F.format_string("%d bp", n.cast("long")))
