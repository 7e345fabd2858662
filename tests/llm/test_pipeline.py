"""The corpus pipeline, stage by stage on the small table with awkward rows added, against plain Python."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sheafline.llm import near_copies, secrets, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd = [(900_001, None, "en", None, 0), (900_002, "", "en", "src1", 0), (900_003, "password = 'hunter2hunter2' end", "en", "src1", 31), (900_004, "one two", None, "src2", 7), (900_005, "one two", None, "src2", 7)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], small).cache())
    return out


def test_stages_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and df.dtypes == stages[0].dtypes


def test_toxicity_keeps_what_scores_low(spark, small, stages):
    model = toxicity.train(stages[0], spark.read.parquet(f"{small}/labels.parquet"))
    want = {r["doc_id"] for r in stages[0].collect() if model.score(r["text"] or "") < toxicity.THRESHOLD}
    assert {r["doc_id"] for r in stages[1].collect()} == want


def test_one_of_each_class_stays(stages):
    rows = {r["doc_id"]: r["text"] or "" for r in stages[1].collect()}
    kept = {r["doc_id"] for r in stages[2].collect()}
    sets = {i: set(near_copies.shingles(t).tolist()) for i, t in rows.items()}
    like = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    assert not any(like(a, b) for a in kept for b in kept if a < b and sets[a] and sets[b])
    for gone in rows.keys() - kept:
        assert any(like(gone, other) for other in rows if other < gone)
    assert 900_005 not in kept and {900_001, 900_002, 900_004} <= kept


def test_secrets_are_masked(stages):
    before, after = ({r["doc_id"]: r["text"] for r in df.collect()} for df in stages[2:4])
    assert before.keys() == after.keys() and after[900_001] is None and after[900_003] == "[SECRET]' end"
    for i, t in after.items():
        assert not secrets.base_spans(t or "")
        if not secrets.base_spans(before[i] or "") and "[SECRET]" not in (t or ""):
            assert t == before[i]


def test_mixture_and_encoding(stages):
    before = {r["doc_id"]: r["text"] or "" for r in stages[3].collect()}
    mixed, seen = stages[4].collect(), Counter()
    for r in mixed:
        words = WORD.findall(r["text"])
        assert words == WORD.findall(before[r["doc_id"]])[: len(words)] and r["n_chars"] == len(r["text"])
        seen[r["doc_id"]] += len(words)
    total = sum(len(WORD.findall(t)) for t in before.values())
    assert abs(sum(seen.values()) - 1.5 * total) <= len({r["source"] for r in mixed})
    assert all(n <= 2 * len(WORD.findall(before[i])) for i, n in seen.items())
    want = Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in mixed)
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in stages[5].collect()) == want


def test_run_equals_the_stages(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.where(F.col("n_tokens") <= 0).count() == 0


def test_clashing_columns_null_and_repeated_ids_through_all_stages(spark, small):
    """Every stage keeps extra columns of any name, and tells documents apart by id and text."""
    names = ["_size", "_hash", "_block", "_draws", "_taken", "_node", "_kept", "_id", "_key", "_spans", "shard", "place", "node", "row", "score", "key", "found", "a.b"]
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    odd = [(None, words(1), "en", None, 1), (None, words(2), "en", None, 1), (7_000_001, words(3), "en", "s", 1), (7_000_001, words(4), "en", "s", 1), (None, None, None, None, None), (7_000_002, words(3) + " more", "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    for n in names:
        docs = docs.withColumn(n, F.lit(f"is {n}"))
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, small).cache()
        assert now.columns == docs.columns and now.dtypes == docs.dtypes, name
        assert all(r[n] == f"is {n}" for r in now.select(*[F.col(f"`{n}`").alias(n) for n in names]).distinct().collect() for n in names), name
        if name == "near copies":
            texts = sorted(r["text"] for r in now.where("text LIKE 'w%x0 %'").collect())
            assert texts == sorted(words(k) for k in (1, 2, 3, 4))
            assert now.where("text IS NULL").count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, now, small).count() == now.count()


def test_empty_tables_through_all_stages(spark, small, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{small}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
