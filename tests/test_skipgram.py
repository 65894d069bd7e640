"""Skip-gram vectors without a vocabulary on the driver: the tree, the steps and what the vectors tell."""

import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import features, skipgram


def least_cost(weights):
    heap, cost = sorted(weights), 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@pytest.mark.parametrize("sizes", [{1: 1}, {3: 2}, {1: 7, 2: 3, 3: 1, 50: 1}, {1: 1000, 2: 301, 5: 17, 6: 1, 400: 2, 9000: 1}, {n: 1 for n in range(1, 40)}])
def test_tree_over_counts_is_a_huffman_tree(sizes):
    tree = skipgram.Huffman(sizes)
    paths = {(n, i): tree.path(c, i) for c, n in enumerate(sorted(sizes)) for i in range(sizes[n])}
    assert sum(n * len(sides) for (n, _), (_, sides) in paths.items()) == least_cost([n for n, m in sizes.items() for _ in range(m)])
    codes = ["".join(map(str, reversed(sides))) for _, sides in paths.values()]
    assert len(set(codes)) == len(codes) and sum(2.0 ** -len(c) for c in codes) == 1.0
    steps = {}
    for nodes, sides in paths.values():  # a node is always reached by the same turns from the root
        for k, node in enumerate(nodes):
            assert steps.setdefault(node, tuple(sides[k + 1 :])) == tuple(sides[k + 1 :])
    assert sorted(steps) == list(range(sum(sizes.values()) - 1)) and len(set(steps.values())) == len(steps)


def test_a_step_climbs_the_likelihood():
    tree = skipgram.Huffman({2: 2, 5: 1, 9: 2})
    trainer = skipgram.Trainer(tree, 4, 2, 1, 1e9)
    places = trainer.numbers(np.array([2, 5, 9, 9, 2]), np.array([1, 1, 1, 2, 2]))
    trainer.inner = np.random.default_rng(1).normal(size=trainer.inner.shape)

    def loss(words, inner):
        total = 0.0
        for w, c in pairs:
            at = slice(trainer.begin[w], trainer.begin[w] + trainer.length[w])
            for node, side in zip(trainer.path_nodes[at], trainer.path_sides[at]):
                total += np.log1p(np.exp((2 * side - 1) * (words[c] @ inner[node])))
        return total

    pairs = [(places[0], places[1]), (places[2], places[1]), (places[4], places[3]), (places[0], places[1])]
    words, inner = trainer.words.copy(), trainer.inner.copy()
    trainer._step(*map(np.array, zip(*pairs)))
    for old, new, of in ((words, trainer.words, lambda x: loss(x, inner)), (inner, trainer.inner, lambda x: loss(words, x))):
        slope = np.zeros_like(old)
        for at in np.ndindex(old.shape):
            step = np.zeros_like(old)
            step[at] = 1e-6
            slope[at] = (of(old + step) - of(old - step)) / 2e-6
        assert np.allclose(new - old, -skipgram.RATE * slope, atol=1e-8)


def test_words_of_one_topic_are_near(spark):
    source = random.Random(2)
    topics = [[f"{t}{k}" for k in range(8)] for t in "ab"]
    lines = [([source.choice(topic) for _ in range(12)],) for topic in topics for _ in range(1500)] + [(["rare", None, "a0"],), (None,), ([],)]
    df = spark.createDataFrame(lines, "t array<string>").withColumn("other", F.lit(1))
    rows = features.word_vectors(df, "t", size=8, window=3, parts=2).collect()
    vectors = {r.word: np.array(r.vec) for r in rows}
    assert len(rows) == len(vectors) == 17 and all(v.shape == (8,) for v in vectors.values())
    unit = {w: v / np.linalg.norm(v) for w, v in vectors.items() if w != "rare"}
    same = [unit[a] @ unit[b] for a in unit for b in unit if a < b and a[0] == b[0]]
    across = [unit[a] @ unit[b] for a in unit for b in unit if a[0] < b[0]]
    assert min(same) > max(across)
    assert {r.word for r in features.word_vectors(df, "t", size=8, min_count=2, parts=2).collect()} == set(unit)
    assert features.word_vectors(df.filter("t IS NULL"), "t", size=8).count() == 0


def test_vocabulary_stays_off_the_driver(spark, monkeypatch):
    """Only the different counts are collected: with 3,000 words that stand once, one row."""
    got = []
    plain = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: got.append(plain(df)) or got[-1])
    df = spark.createDataFrame([([f"w{i}x{k}" for k in range(10)],) for i in range(300)], "t array<string>")
    found = features.word_vectors(df, "t", size=4)
    assert sum(map(len, got)) == 1 and found.count() == 3000
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
