"""The pipeline's stages, each against what it says."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sigloom.llm import decontam, neardup, quality, queries
from sigloom.session import materialise
from test_llm_operators import brute_substrings, near_copies, shingle_set

STAGE = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_run_is_the_stages_in_order(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = d.columns, rows_of(d)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = materialise(stage(spark, d, small), name)
        assert d.columns == columns
        if name != "substring_dedup":
            assert not rows_of(d) - seen
        seen = rows_of(d)
    out = corpus_pipeline.run(spark, small)
    assert out.count() == d.count() and {"token_ids", "n_tokens"} <= set(out.columns)
    for r in out.collect():
        assert r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest() and len(r["token_ids"]) == r["n_tokens"]


def test_quality_stage_drops_what_the_classifier_rejects(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    lab = spark.read.parquet(f"{small}/labels.parquet")
    good = {r["doc_id"] for r in quality.classify(d, lab).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in STAGE["quality"](spark, d, small).collect()} == good


def test_near_duplicate_stage_keeps_one_of_each_group(spark, small):
    rows = near_copies(21, 60) + [(1, None), (2, ""), (3, "same text of five words"), (3, "same text of five words"), (4, "same text of five words"), (None, "another text of five words"), (None, "another text of five words")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("_h", F.lit(1))
    out = STAGE["near_duplicates"](spark, d, small)
    left = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert out.columns == d.columns and Counter(i for i, _ in left)[3] == 1 and 4 not in [i for i, _ in left] and [i for i, _ in left].count(None) == 1 and {1, 2} <= {i for i, _ in left}
    groups = {r["doc_id"]: r["component_id"] for r in neardup.group(spark.createDataFrame(rows[:60], "doc_id long, text string"), ["doc_id"], shingle=5).collect()}
    assert {i for i, _ in left if i is not None and i >= 1000} == set(groups.values())
    sets = [shingle_set(t, 5) for i, t in left if t]
    assert all(100 * len(a & b) < 80 * len(a | b) for k, a in enumerate(sets) for b in sets[:k])


def test_substring_stage_rewrites_only_what_loses_words(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    before = {r["doc_id"]: r for r in d.collect()}
    want = {i: (n, digest) for i, _, n, digest in brute_substrings([(i, r["text"]) for i, r in before.items()], 35)}
    for r in STAGE["substring_dedup"](spark, d, small).collect():
        n, digest = want[r["doc_id"]]
        if n:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == digest and r["n_chars"] == len(r["text"])
        else:
            assert r == before[r["doc_id"]]


def test_decontamination_stage(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    bad = {r["doc_id"] for r in decontam.matches(d, spark.read.parquet(f"{small}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in STAGE["decontamination"](spark, d, small).collect()} == {r["doc_id"] for r in d.collect()} - bad


@pytest.mark.parametrize("name", list(STAGE))
def test_stages_take_awkward_and_empty_tables(spark, small, name):
    rows = [(1, None), (2, ""), (None, "x y z"), (3, "word " * 5000), (3, "word " * 5000)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("score", "kept", "n_chars", "_row", "component_id", "n_tokens", "_block", "a b"):
        d = d.withColumn(c, F.lit(None).cast("long") if c == "n_chars" else F.lit("clash"))
    out = STAGE[name](spark, d, small)
    assert [c for c in out.columns if c in d.columns] == d.columns and out.count() <= len(rows)
    assert STAGE[name](spark, d.limit(0), small).count() == 0


def test_registered_queries_cover_the_whole_table(spark, small):
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    for name in ("op1_quality_fm", "op9_bpe_monoid", "op10_language_id"):
        assert queries.QUERIES[name](spark, small).count() == n
