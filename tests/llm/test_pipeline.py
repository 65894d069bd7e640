"""Every stage of the corpus pipeline against brute force over what its predecessor kept, and odd rows."""

import hashlib

import corpus_pipeline
import pytest
from tiktoken import Encoding
from pyspark.sql import functions as F
from test_duplicates import near_by_brute_force

from tabloom.llm import bpe, quality

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w for w in (text or "").translate(LOWER).replace("\x0b", " ").split() if w]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def expected_exact(rows):
    keep = {}
    for r in rows:
        norm = (r["text"] or "").translate(LOWER)
        if r["doc_id"] is not None:
            keep[norm] = max(keep.get(norm, r["doc_id"]), r["doc_id"])
    return [r for r in rows if r["doc_id"] == keep.get((r["text"] or "").translate(LOWER))]


def expected_near(rows):
    found = near_by_brute_force([(r["doc_id"], r["text"]) for r in rows])
    return [r for r in rows if found[r["doc_id"]][1] == r["doc_id"]]


def expected_clean(rows, items):
    own = [shingles(t) for t in items]
    return [r for r in rows if not any(s and len(s & shingles(r["text"])) >= 0.8 * len(s) - 1e-9 for s in own)]


def key(rows):
    return sorted((str(r["doc_id"]), str(r["text"])) for r in rows)


def test_stages_against_brute_force(spark):
    docs = corpus_pipeline.table(spark, FOLDER, "documents")
    labels, items = corpus_pipeline.table(spark, FOLDER, "labels"), [r["text"] for r in corpus_pipeline.table(spark, FOLDER, "benchmark").collect()]
    good = {r["doc_id"] for r in quality.quality_scores(docs, labels).filter("predicted = 1").collect()}
    rows = docs.collect()
    steps = {
        "quality classifier": lambda rows: [r for r in rows if r["doc_id"] in good],
        "exact dedup": expected_exact,
        "n-gram Jaccard join": expected_near,
        "benchmark decontamination": lambda rows: expected_clean(rows, items),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, FOLDER)
        assert found.columns == docs.columns, name
        kept, before = found.collect(), len(rows)
        rows = steps[name](rows)
        assert key(kept) == key(rows) and len(rows) < before, name
        docs = spark.createDataFrame(kept, docs.schema)
    data, pattern = bpe.public_vocabulary()
    ranks = bpe.parse_ranks(data)
    coder = Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    wanted = {r["doc_id"]: coder.encode_ordinary(r["text"]) for r in rows}
    last = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in last} == {k: len(v) for k, v in wanted.items()}
    assert all(r["ids_sha256"] == hashlib.sha256(",".join(map(str, wanted[r["doc_id"]])).encode()).hexdigest() for r in last)


LONG = " ".join(f"word{k}" for k in range(400))
ODD = [
    (1, LONG, "x", 1),
    (1, LONG, "x", 1),  # a repeated row
    (2, LONG.upper(), "y", 2),  # equal after lower-casing: id 2 stays
    (3, LONG + " more", "z", 3),
    (4, None, None, None),
    (5, "", "", 0),
    (None, LONG, "n", 9),
    (None, "nothing else has this", "n", 9),
    (6, "same id, first text", "a", 1),
    (6, "same id, second text", "a", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "clash", True) for r in ODD], "doc_id bigint, text string, lang string, n_chars bigint, key string, root boolean")


def test_exact_stage_of_odd_rows(spark, odd):
    kept = corpus_pipeline.exact_stage(spark, odd, FOLDER)
    assert kept.columns == odd.columns
    left = [(r["doc_id"], (r["text"] or "")[:12]) for r in kept.collect()]
    wanted = [(2, LONG.upper()[:12]), (3, "word0 word1 "), (5, ""), (None, "nothing else"), (6, "same id, fir"), (6, "same id, sec")]
    assert sorted(map(str, left)) == sorted(map(str, wanted))


def test_near_stage_of_odd_rows(spark, odd):
    left = [r["doc_id"] for r in corpus_pipeline.near_stage(spark, odd, FOLDER).collect()]
    assert sorted(map(str, left)) == sorted(map(str, [1, 1, 4, 5, None, None, 6, 6]))


def test_other_stages_of_odd_rows(spark, odd):
    for stage in (corpus_pipeline.quality_stage, corpus_pipeline.benchmark_stage):
        kept = stage(spark, odd, FOLDER)
        assert kept.columns == odd.columns
        assert kept.filter("doc_id IS NULL").count() == 2  # null ids are never dropped
    tokens = corpus_pipeline.token_stage(spark, odd, FOLDER).collect()
    assert len(tokens) == len(ODD) and sum(r["n_tokens"] == 0 for r in tokens) == 2


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_tables(spark, odd, name, stage):
    assert stage(spark, odd.filter(F.lit(False)), FOLDER).count() == 0


def test_texts_are_not_shuffled_by_the_drops(spark):
    docs = corpus_pipeline.table(spark, FOLDER, "documents")
    ids = docs.select("doc_id").filter("doc_id < 20")
    plan = corpus_pipeline.without(docs, ids)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    plan = corpus_pipeline.exact_stage(spark, docs, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
