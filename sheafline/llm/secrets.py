"""Secret scans: fixed patterns, and a battery of randomness tests with length-aware false-discovery control.

Base kinds (assign, access, hex) are found by pattern. Beyond them, every run of token characters that mixes letters
and digits is a candidate. Its encoding is inferred from the characters (hex, base32, alphanumeric, base64) and three
tests ask whether it looks drawn at random from that alphabet: chi-squared uniformity, the number of runs above and
below the alphabet's middle, and lag-one serial correlation. Its score is three times the least p-value, at most 1
(near 0 for ordinary writing); a token whose score is under the rate is structured and never reported.

The null is ordinary writing, and exists at every length: a model of pairs of neighbouring characters, letters without
case, counted over the whole corpus (all runs of token characters but the candidates). Under it the likelihood ratio of
the uniform alphabet to the model passes exp(x) with a probability of exp(-x) at most, which is a candidate's p-value; the
Benjamini-Hochberg rule picks those that are reported as kind "random", in each class of lengths on its own. The model
has 41 times 40 counts and the ratios are counted in 64 cells, so what reaches the driver has a fixed size.

Null texts count as empty; empty texts and empty tables give no spans. Positions are code points, ends exclusive.
Repeated rows give repeated rows. Without any ordinary writing the model is uniform over its characters.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts, written

# The base patterns and the order of their kinds.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs, as [0-9a-f]+ would match them, of the length asked for
KINDS = ("assign", "access", "hex", "random")

TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
DIGIT, LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
#: Cells of the log likelihood ratio, and their width.
CELLS, WIDTH = 64, 0.5
#: Upper ends of the classes of lengths.
LENGTHS = (20, 24, 32, 40, 64, 128)
RATE = 0.01

# The alphabets, in the order in which they are tried.
HEX_LOW, HEX_UP = "0123456789abcdef", "0123456789ABCDEF"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALNUM = "0123456789" + UPPER + LOWER
BASE64 = UPPER + LOWER + "0123456789+/-_"
ALPHABETS = [HEX_LOW, HEX_UP, LOWER, UPPER, BASE32, "0123456789" + LOWER, "0123456789" + UPPER, LOWER + UPPER, ALNUM, BASE64]
SETS = [(frozenset(a), {c: i for i, c in enumerate(a)}) for a in ALPHABETS]

# The model's symbols, 0 for all that is no token character, and the share of its uniform part.
SYMBOLS = LOWER + "0123456789+/_-"
K = len(SYMBOLS) + 1
SYMBOL = {c: 1 + SYMBOLS.index(c.lower()) for c in BASE64}
CODES = np.zeros(256, np.int64)
CODES[[ord(c) for c in SYMBOL]] = list(SYMBOL.values())
UNIFORM = 0.05
#: The log probability of each symbol if characters are drawn from an alphabet.
DRAWN = [{SYMBOL[c]: math.log(sum(SYMBOL[x] == SYMBOL[c] for x in a) / len(a)) for c in a} for a in ALPHABETS]


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_p(values: list[int], k: int) -> float:
    """Upper tail of the chi-squared statistic against a uniform alphabet of k, by the Wilson-Hilferty cube root."""
    n, counts = len(values), [0] * k
    for v in values:
        counts[v] += 1
    x = sum(c * c for c in counts) * k / n - n
    d = k - 1
    return _normal_tail(((x / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d))) if x > 0 else 1.0


def runs_p(values: list[int], k: int) -> float:
    """Two-sided Wald-Wolfowitz test of runs below and from the middle of the alphabet."""
    side = [v >= k / 2 for v in values]
    a, n = sum(side), len(side)
    b = n - a
    if not a or not b:
        return 2.0 ** (1 - n)
    runs = 1 + sum(x != y for x, y in zip(side, side[1:], strict=False))
    mean = 1 + 2 * a * b / n
    var = (mean - 1) * (mean - 2) / max(n - 1, 1)
    return 2 * _normal_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0


def serial_p(values: list[int]) -> float:
    """Two-sided test of the correlation of each character with the next one."""
    n = len(values)
    mean = sum(values) / n
    var = sum((v - mean) ** 2 for v in values)
    if var == 0:
        return 2.0 ** (1 - n)
    r = sum((x - mean) * (y - mean) for x, y in zip(values, values[1:], strict=False)) / var
    return 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n))


def _encoding(body: str) -> int | None:
    used = set(body)
    return next((i for i, (a, _) in enumerate(SETS) if used <= a), None)


def score(token: str) -> float:
    """Three times the least p-value of the battery under the inferred encoding, at most 1."""
    body = token.rstrip("=")
    at = _encoding(body)
    if at is None or len(body) < 2:
        return 0.0
    index = SETS[at][1]
    values = [index[c] for c in body]
    return min(1.0, 3 * min(chi_squared_p(values, len(index)), runs_p(values, len(index)), serial_p(values)))


def pair_counts(text: str) -> np.ndarray:
    """Counts of pairs of symbols, first * K + second, with a 0 before and after the text."""
    codes = np.zeros(len(raw := text.encode()) + 2, np.int64)
    codes[1:-1] = CODES[np.frombuffer(raw, np.uint8)]
    return np.bincount(codes[:-1] * K + codes[1:], minlength=K * K)


def text_model(pairs: dict[int, int]) -> list[list[float]]:
    """Log probabilities of a symbol after another one, given that the run of token characters goes on."""
    n = np.zeros(K * K)
    n[list(pairs)] = list(pairs.values())
    n = n.reshape(K, K)[:, 1:]
    single = (n.sum(0) + 1) / (n.sum() + K - 1)
    after = (n + K * single) / (n.sum(1, keepdims=True) + K)
    logs = np.log((1 - UNIFORM) * after + UNIFORM / (K - 1))
    return np.hstack([np.zeros((K, 1)), logs]).tolist()


def length_class(size: int) -> int:
    return sum(size > x for x in LENGTHS)


def ratio_cell(token: str, model: list[list[float]]) -> int:
    """Cell of the log likelihood ratio of the inferred encoding, drawn uniformly, to the model of ordinary text."""
    body = token.rstrip("=")
    drawn, before, total = DRAWN[_encoding(body)], 0, 0.0
    for c in body:
        x = SYMBOL[c]
        total, before = total + drawn[x] - model[before][x], x
    return max(0, min(CELLS - 1, int(total / WIDTH)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def mixed(text: str):
    """Matches of the runs of token characters with letters and digits."""
    return (m for m in TOKEN.finditer(text) if DIGIT.search(m[0]) and LETTER.search(m[0]))


def candidates(text: str, base: list[tuple[int, int, int]], rate: float = RATE) -> list[tuple[int, int, int, str | None]]:
    """Candidates outside the base spans as (start, end, class, token); no token if the battery finds it structured."""
    # both are in order; taken so far, base spans reach to the greatest of their ends
    out, at, reach = [], 0, 0
    for m in mixed(text):
        while at < len(base) and base[at][0] < m.end():
            reach, at = max(reach, base[at][2]), at + 1
        if reach <= m.start():
            out.append((m.start(), m.end(), length_class(len(m[0].rstrip("="))), m[0] if score(m[0]) >= rate else None))
    return out


def ordinary_pairs(text: str) -> np.ndarray:
    """pair_counts() without the runs that may be candidates, which so cannot shape the null that judges them."""
    counts = pair_counts(text)
    for m in mixed(text):
        counts -= pair_counts(m[0].rstrip("="))
    return counts


def show(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCANNED = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "base array<struct<start:int,kind:int,end:int>>, cand array<struct<start:int,end:int,class:int,token:string>>, ordinary array<struct<pair:int,n:long>>"
)


def _scan(batches, rate: float = RATE):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string())]
        + [("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])))]
        + [("cand", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("class", pa.int32()), ("token", pa.string())])))]
        + [("ordinary", pa.list_(pa.struct([("pair", pa.int32()), ("n", pa.int64())])))]
    )
    names = [[f.name for f in schema.field(x).type.value_type] for x in ("base", "cand", "ordinary")]
    for batch in batches:
        rows, pairs = [], np.zeros(K * K, np.int64)
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = t.as_py()
            base = base_spans(text)
            n = [sum(k == x for _, k, _ in base) for x in range(3)]
            pairs += ordinary_pairs(text)
            rows.append([i, *n, hashlib.sha256(show(base).encode()).hexdigest(), base, candidates(text, base, rate), []])
        if rows:
            # the counts of a batch hang on its first row
            rows[0][-1] = [(int(k), int(pairs[k])) for k in np.flatnonzero(pairs)]
        cols = list(zip(*rows, strict=True)) or [()] * 8
        for k, fields in zip((5, 6, 7), names, strict=True):
            cols[k] = [[dict(zip(fields, x, strict=True)) for x in v] for v in cols[k]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def scan(docs: DataFrame, rate: float = RATE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base spans and candidates of each document, and counts of pairs of symbols, whose sum over all rows is the corpus's."""
    return texts(docs, doc_id, text).mapInArrow(lambda batches: _scan(batches, rate), SCANNED)


def fit(scanned: DataFrame) -> list[list[float]]:
    """The model of ordinary text; counts are summed on the executors, K * K of them at most come back."""
    pairs = scanned.select(F.explode("ordinary").alias("x")).groupBy("x.pair").agg(F.sum("x.n").alias("n"))
    return text_model({r["pair"]: r["n"] for r in pairs.collect()})


def with_cells(scanned: DataFrame, model: list[list[float]]) -> DataFrame:
    """Candidates as (start, end, class, cell)."""

    @F.pandas_udf("array<int>")
    def cells(tokens: pd.Series) -> pd.Series:
        return tokens.map(lambda x: [0 if t is None else ratio_cell(t, model) for t in x])

    both = F.arrays_zip("cand", cells(F.col("cand.token")).alias("cell"))
    named = F.transform(both, lambda x: F.struct(x["cand"]["start"].alias("start"), x["cand"]["end"].alias("end"), x["cand"]["class"].alias("class"), x["cell"].alias("cell")))
    return scanned.withColumn("cand", named)


def thresholds(celled: DataFrame, rate: float = RATE) -> dict[int, int]:
    """The least cell that is reported, by class of lengths; classes without any are left out.

    The counts of all documents are summed on the executors; classes times cells is all that comes back.
    """
    counts: dict[int, list[int]] = {}
    for r in celled.select(F.explode("cand").alias("x")).groupBy("x.class", "x.cell").count().collect():
        counts.setdefault(r["class"], [0] * CELLS)[r["cell"]] += r["count"]
    out = {}
    for k, real in counts.items():
        above = 0
        for cell in reversed(range(1, CELLS)):
            above += real[cell]
            if above and math.exp(-WIDTH * cell) * sum(real) <= rate * above:
                out[k] = cell
    return out


def find_secrets(docs: DataFrame, rate: float = RATE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts and digest of the base kinds, and all spans as text and as an array found."""
    scanned = written(scan(docs, rate, doc_id, text), "secrets")
    celled = with_cells(scanned, fit(scanned))
    least = thresholds(celled, rate)
    text_of = " ".join(f"WHEN {k} THEN {c}" for k, c in least.items())
    passed = f"filter(cand, x -> x.cell >= CASE x.class {text_of} ELSE {CELLS} END)" if least else "filter(cand, x -> false)"
    added = F.expr(f"transform({passed}, x -> struct(x.start AS start, 3 AS kind, x.end AS end))")
    names = ", ".join(f"'{k}'" for k in KINDS)
    shown = F.expr(f"array_join(transform(found, x -> concat(element_at(array({names}), x.kind + 1), ':', x.start, ':', x.end)), ',')")
    return (
        celled.withColumn("found", F.array_sort(F.concat("base", added)))
        .withColumn("spans", shown)
        .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found")
    )


def redact(docs: DataFrame, mask: str = "[SECRET]", rate: float = RATE) -> DataFrame:
    """The documents with every span that is found replaced by a mask; the other columns stay as they are.

    The text is read twice: once for the corpus's model and thresholds and once to replace, so that it need not be kept aside.
    """
    small_batches(docs.sparkSession)
    scanned = written(scan(docs, rate).select("cand", "ordinary"), "secret-counts")
    model = fit(scanned)
    least = thresholds(with_cells(scanned, model), rate)

    @F.pandas_udf("string")
    def clean(series):
        return series.map(lambda t: None if t is None else mask_text(t, model, least, mask, rate))

    return docs.withColumn("text", clean("text"))


def mask_text(text: str, model: list[list[float]], least: dict[int, int], mask: str, rate: float = RATE) -> str:
    base = base_spans(text)
    found = base + [(s, 3, e) for s, e, k, t in candidates(text, base, rate) if t is not None and ratio_cell(t, model) >= least.get(k, CELLS)]
    out, at = [], 0
    for s, _, e in sorted(found):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:] if found else text
