"""Toxicity: a linear classifier trained with a counterfactual penalty.

Features tell whether a word, or a word beginning of three to eight letters, occurs at least once, twice or four times;
so inflected forms of a word share weight. Features whose share differs too little between the labels are left out. The vocabulary and weights are fitted on a bounded sample of labelled documents (MOST_LABELLED of each
label, those of the least hash of their id, so that every run takes the same ones). Besides the log loss, the fit
penalises the squared change of the logit when an identity term in a labelled sentence is swapped for another one:
the weight that a mere mention of a group can gain is driven towards that of every other group, and a neutral mention
no longer raises the score. The identity terms given here are English; those of other languages can be passed to fit().

Null texts count as empty and are scored; documents without label, and labels without document, take no part in the
fit. With labels of one kind only, or none, every score is the base rate (0.5 without labels). Repeated rows are
scored each. Labels given twice for one document count as toxic if any of them says so.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts, written

#: Labelled documents of each label that the fit takes at most.
MOST_LABELLED = 4000
#: Features that the model keeps at most, those that tell the labels apart best.
MOST_FEATURES = 8192
#: Labelled documents that hold a feature, and standard errors between its shares in the two labels, at least.
LEAST_DOCUMENTS, LEAST_GAIN = 3, 4.0
#: Weight of the squared-weight penalty and of the counterfactual one.
RIDGE, COUNTERFACTUAL, ROUNDS = 3e-4, 1.0, 400
THRESHOLD = 0.7

# Terms for groups of people whose mention must not count as toxic.
IDENTITY_TERMS = tuple(
    "women men woman man black white asian african european arab american mexican indian chinese jewish jews muslim muslims "
    "christian christians hindu buddhist atheist gay lesbian bisexual straight transgender trans queer immigrant immigrants "
    "refugee refugees disabled blind deaf elderly young old poor rich".split()
)

WORD = re.compile(r"[^\W_]+")
#: Ends a sentence, for the counterfactual sentences.
SENTENCE = re.compile(r"[.!?\n]+")


LEVELS = (1, 2, 4)


def parts(word: str) -> list[str]:
    """A word and its beginnings, marked by a final asterisk."""
    return [word, *(word[:k] + "*" for k in range(3, min(8, len(word)) + 1))]


def features(text: str) -> set[str]:
    """What occurs, and with #2 or #4 behind it what occurs so often at least."""
    counts: Counter = Counter()
    for w, n in Counter(WORD.findall(text.lower())).items():
        for f in parts(w):
            counts[f] += n
    return {f if k == 1 else f"{f}#{k}" for f, n in counts.items() for k in LEVELS if n >= k}


def swaps(text: str, terms: tuple[str, ...]) -> Counter:
    """How often a text's sentences mention (term, other term): four others stand in for each mention, so there are few pairs however long it is."""
    place, found = {t: i for i, t in enumerate(terms)}, Counter()
    for sentence in SENTENCE.split(text.lower()):
        found.update(w for w in WORD.findall(sentence) if w in place)
    return Counter({(w, terms[(place[w] + k) % len(terms)]): n for w, n in found.items() for k in (1, 5, 13, 19) if k % len(terms)})


class Model:
    """Weights by feature, and the bias."""

    #: Words whose known parts are kept at most; beyond this they are forgotten.
    KEPT_WORDS = 150_000

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.stems = frozenset(f.split("#")[0] for f in weights)
        self.known: dict[str, tuple[str, ...]] = {}

    def score(self, text: str) -> float:
        counts: dict[str, int] = {}
        for w in WORD.findall(text.lower()):
            mine = self.known.get(w)
            if mine is None:
                if len(self.known) >= self.KEPT_WORDS:
                    self.known.clear()
                mine = self.known[w] = tuple(f for f in parts(w) if f in self.stems)
            for f in mine:
                counts[f] = counts.get(f, 0) + 1
        held = sorted(self.weights.get(f if k == 1 else f"{f}#{k}", 0.0) for f, n in counts.items() for k in LEVELS if n >= k)
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(held), -50, 50))))


def informative(counts, n: tuple[int, int]) -> list[str]:
    """The features that tell the labels apart best; counts: (feature, documents of label 0, documents of label 1)."""
    gain = {}
    for f, a, b in counts:
        share = (a + b) / (n[0] + n[1])
        spread = math.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
        if a + b >= LEAST_DOCUMENTS and spread > 0 and abs(b / n[1] - a / n[0]) >= LEAST_GAIN * spread:
            gain[f] = abs(b / n[1] - a / n[0]) / spread
    return sorted(gain, key=lambda f: (-gain[f], f))[:MOST_FEATURES]


def encoded(text: str, index: dict[str, int], terms: tuple[str, ...]) -> tuple[list[int], list[tuple[list[int], list[int], int]]]:
    """A document's features, and for each swap in it the features that go, those that come, and how often."""
    at = lambda fs: sorted(index[f] for f in fs if f in index)
    return at(features(text)), [(at(features(a) - features(b)), at(features(b) - features(a)), n) for (a, b), n in swaps(text, terms).items()]


def optimise(index: dict[str, int], y: np.ndarray, found: list, rounds: int = ROUNDS, counterfactual: float = COUNTERFACTUAL) -> Model:
    """Weights by accelerated gradient descent; found holds a row of encoded() for each label in y."""
    d = len(index)
    row_of = np.repeat(np.arange(len(found)), [len(x) for x, _ in found])
    col_of = np.array([c for x, _ in found for c in x], np.int64)
    pairs = Counter()
    for _, x in found:
        for a, b, n in x:
            pairs[tuple(a), tuple(b)] += n
    swapped = [(np.array(a, np.int64), np.array(b, np.int64), c / len(y)) for (a, b), c in sorted(pairs.items()) if a or b]
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))  # both labels weigh the same
    w, v, bias, vb, step = np.zeros(d), np.zeros(d), 0.0, 0.0, 0.5
    bend = np.zeros(d)  # of the penalty, which would overshoot with the step of the loss alone
    for a, b, c in swapped:
        np.add.at(bend, np.concatenate([a, b]), 2 * counterfactual * c * (len(a) + len(b)))
    scale = 1 / (np.sqrt(1 + np.bincount(col_of, minlength=d) / len(y) * 4) + bend)
    for k in range(rounds):
        aw, ab = w + k / (k + 3) * v, bias + k / (k + 3) * vb
        z = ab + np.bincount(row_of, aw[col_of], len(y))
        err = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(y)
        g = np.bincount(col_of, err[row_of], d) + RIDGE * aw
        for a, b, c in swapped:
            change = aw[a].sum() - aw[b].sum()
            np.add.at(g, a, 2 * counterfactual * c * change)
            np.add.at(g, b, -2 * counterfactual * c * change)
        nw, nb = aw - step * scale * g, ab - step * err.sum()
        v, vb, w, bias = nw - w, nb - bias, nw, nb
    return Model({f: float(w[i]) for f, i in index.items() if w[i] != 0}, float(bias))


def base_rate(n: tuple[int, int]) -> Model | None:
    """A model without features where only one label, or none, is known."""
    return None if n[0] and n[1] else Model({}, math.log((n[1] + 1) / (n[0] + 1)))


def fit(rows: list[tuple[str, int]], terms: tuple[str, ...] = IDENTITY_TERMS, rounds: int = ROUNDS, counterfactual: float = COUNTERFACTUAL) -> Model:
    """Fits the model to (text, label) rows in one process; train() does the same with Spark."""
    n = (sum(t == 0 for _, t in rows), sum(t == 1 for _, t in rows))
    if flat := base_rate(n):
        return flat
    counts: dict[str, list[int]] = {}
    for text, t in rows:
        for f in features(text):
            counts.setdefault(f, [0, 0])[t] += 1
    index = with_terms(informative(((f, *c) for f, c in counts.items()), n), terms)
    return optimise(index, np.array([t for _, t in rows], float), [encoded(t, index, terms) for t, _ in rows], rounds, counterfactual)


def with_terms(kept: list[str], terms: tuple[str, ...]) -> dict[str, int]:
    """The identity terms belong to the model even where they are no good as features: swaps then hold their weights together."""
    return {f: i for i, f in enumerate(dict.fromkeys([*kept, *terms]))}


def held_out(doc_id) -> F.Column:
    """Rows that take no part in the fit."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Fits on the labelled documents outside the held-out fold, at most so many of each label."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marked = marked.where(~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [marked.where(F.col("toxic") == t).orderBy(*order).limit(most) for t in (0, 1)]
    both = chosen[0].unionByName(chosen[1])
    sample = written(texts(docs).join(F.broadcast(both), "doc_id").select("doc_id", "toxic", "text"), "toxic-sample")  # joined to 2 * most rows of two numbers
    n = tuple(sample.where(F.col("toxic") == t).count() for t in (0, 1))
    if flat := base_rate(n):
        return flat

    def count(batches):
        found: dict[str, list[int]] = {}
        for batch in batches:
            for t, text in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                for f in features(text.as_py()):
                    found.setdefault(f, [0, 0])[t] += 1
        for at in range(0, len(found), 50_000):
            part = list(found.items())[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in part]), pa.array([c[0] for _, c in part], pa.int64()), pa.array([c[1] for _, c in part], pa.int64())], ["feature", "n0", "n1"])

    counts = sample.mapInArrow(count, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    share, apart = (F.col("n0") + F.col("n1")) / (n[0] + n[1]), F.abs(F.col("n1") / n[1] - F.col("n0") / n[0])
    spread = F.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
    told = counts.where((F.col("n0") + F.col("n1") >= LEAST_DOCUMENTS) & (apart >= 0.999 * LEAST_GAIN * spread)).orderBy(F.desc(apart / F.greatest(spread, F.lit(1e-9))), "feature").limit(2 * MOST_FEATURES)
    index = with_terms(informative([tuple(r) for r in told.collect()], n), IDENTITY_TERMS)

    def encode(batches):
        pair = pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("n", pa.int64())])
        for batch in batches:
            found = [encoded(t.as_py(), index, IDENTITY_TERMS) for t in batch.column(2)]
            swapped = [[{"a": a, "b": b, "n": n} for a, b, n in x] for _, x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.list_(pa.int32())), pa.array(swapped, pa.list_(pair))], ["doc_id", "toxic", "at", "swapped"])

    rows = sample.mapInArrow(encode, "doc_id long, toxic int, at array<int>, swapped array<struct<a:array<int>,b:array<int>,n:long>>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["at"]))
    found = [(r["at"], [(list(x["a"]), list(x["b"]), x["n"]) for x in r["swapped"]]) for r in rows]
    return optimise(index, np.array([r["toxic"] for r in rows], float), found)


def score_texts(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted for each document."""

    def run(batches):
        for batch in batches:
            found = [model.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    scored = texts(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(series):
        return series.map(lambda t: model.score(t or ""))

    return docs.where(score("text") < threshold)
