"""Periodic runs against the definition, place by place and lag by lag."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabloom.llm import periodic

FOLDER = "/root/testdata/sf0.001"


def by_definition(words, least=12):
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                if not any(all(words[t] == words[t + p] for t in range(i, j + q - p)) for p in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_in(texts, least=12):
    _, numbers, doc, first = periodic._numbered([" ".join(t) for t in texts])
    runs = periodic.runs_of(numbers, doc, least).tolist()
    return [[(s - int(first[k]), n, q) for s, n, q in runs if doc[s] == k] for k in range(len(texts))]


PIECE = st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=14), st.integers(1, 6)).map(lambda x: x[0] * x[1])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PIECE, max_size=4).map(lambda parts: [w for p in parts for w in p]), min_size=1, max_size=4))
def test_runs_of_random_repetitions(texts):
    assert runs_in(texts) == [by_definition(t) for t in texts]


@pytest.mark.parametrize("least", [4, 7, 12, 20])
def test_other_shortest_lengths(least):
    rng = random.Random(least)
    texts = [[rng.choice("ab") for _ in range(rng.randint(0, 60))] for _ in range(120)]
    assert runs_in(texts, least) == [by_definition(t, least) for t in texts]


def test_fibonacci_words():
    a, b = ["a"], ["a", "b"]
    for _ in range(9):
        a, b = b, b + a
    assert runs_in([b]) == [by_definition(b)]


def test_long_and_highly_periodic_texts_stay_fast():
    one = np.append(np.zeros(1_000_000, np.int64), 1)
    assert periodic.runs_of(one, np.zeros(len(one), np.int64)).tolist() == [[0, 1_000_000, 1]]
    nested = np.append(np.tile(np.append(np.tile([0, 1, 2], 20), 3), 5_000), 4)
    found = periodic.runs_of(nested, np.zeros(len(nested), np.int64)).tolist()
    assert [0, 305_000, 61] in found and len(found) == 5_001


def test_pairs_are_bounded_by_the_words():
    """At most two pairs per word in a class of lags, however often a k-gram repeats."""
    words = np.zeros(2_000, np.int64)
    grams = periodic.Grams(words, words)
    for k, low, high in periodic.lag_classes(len(words)):
        grams.grow(k)
        assert grams.length == k
        assert sum(len(at) for at, _ in grams.pairs(low, high)) <= 2.4 * len(words)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = by_definition(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    facts = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *facts, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_against_the_definition(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = sorted(tuple(r) for r in periodic.op13_periodic(spark, FOLDER).collect())
    assert found == sorted(expected(r["doc_id"], r["text"]) for r in docs)
    assert sum(r[1] > 0 for r in found) > 20


def test_odd_rows(spark):
    chosen = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    rows = [
        (chosen, None, 1), (chosen, "", 2), (chosen, " \t\n", 3), (chosen, "one", 4), (chosen, "a b " * 30, 5), (chosen, "a b " * 30, 5),
        (chosen, "é x é x " * 7, 6), (5, "w " * 200_000, 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    found = sorted(map(str, (tuple(r) for r in periodic.run_digests(periodic.periodic_runs(periodic.planted(docs))).collect())))
    quick = [expected(*r[:2]) for r in rows if r[0] == chosen]
    words = "w " * 200_000
    long = (5, 1, 0, 200_000, 1, 200_000_000, hashlib.sha256(b"0,200000,1\n").hexdigest(), hashlib.sha256(b"w").hexdigest())
    assert words and found == sorted(map(str, [*quick, long]))
    plain = spark.createDataFrame([(None, "x y " * 10)], "doc_id bigint, text string")
    row = periodic.periodic_runs(periodic.planted(plain)).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 20, 2)] and row["collapsed"] == "x y"
    assert periodic.periodic_runs(docs.filter("doc_id < -1")).count() == 0
