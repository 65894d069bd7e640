"""Skip-gram word vectors with a hierarchical softmax, for vocabularies of any size.

The method is that of Spark's `Word2Vec` with one iteration: every partition
trains on its sentences from the same first vectors, and the vectors of a word
are averaged over the partitions that hold it. Spark keeps the vocabulary, the
Huffman tree and all vectors on the driver and sends them to every executor.
Here a task has the words and tree nodes of its own sentences only: equally
frequent words are interchangeable in a Huffman tree, so it is built over the
different counts (at most about the square root of twice the tokens) and a word
finds its path by its count and its rank among the words of that count.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.lookup import keyed_lookup
from tabloom.operators.ranking import hashed_rank
from tabloom.operators.vocabulary import gather, token_rows
from tabloom.session import cut_lineage

RATE = 0.025
LEAST_RATE = RATE * 1e-4
MOST_SCORE = 6.0
#: Tokens whose pairs are one step: their sums use the vectors from before it.
STEP_TOKENS = 32
#: Vectors in a batch that a task hands on.
OUT_ROWS = 10_000


class Huffman:
    """The Huffman tree over words of which `sizes` of each count are known: {count: words with it}.

    The items of a class weigh the same. The lightest class is joined in pairs
    to a class of half as many items; an odd item joins the last one of the next class.
    """

    def __init__(self, sizes: dict[int, int]):
        self.counts = sorted(sizes)
        self.pairs: dict[int, tuple[int, int]] = {}  # class: the class of its pairs, and its items in pairs
        self.singles: dict[tuple[int, int], tuple[int, int]] = {}  # (class, item): class of the joined item, side
        self.first: dict[int, int] = {}  # number of the first node of a joined class
        heap = [(n, c, sizes[n]) for c, n in enumerate(self.counts)]
        heapq.heapify(heap)
        self.nodes, made, odd = 0, len(heap), None

        def joined(items: int) -> int:
            nonlocal made
            self.first[made] = self.nodes
            self.nodes += items
            made += 1
            return made - 1

        while heap:
            weight, c, m = heapq.heappop(heap)
            if odd is not None:
                to = joined(1)
                self.singles[odd[1:]], self.singles[c, m - 1] = (to, 0), (to, 1)
                heapq.heappush(heap, (odd[0] + weight, to, 1))
                odd = None
                if m > 1:
                    heapq.heappush(heap, (weight, c, m - 1))
                continue
            if m == 1 and not heap:
                break
            if m > 1:
                to = joined(m // 2)
                self.pairs[c] = to, m - m % 2
                heapq.heappush(heap, (2 * weight, to, m // 2))
            if m % 2:
                odd = weight, c, m - 1

    def path(self, c: int, item: int) -> tuple[list[int], list[int]]:
        """(nodes, sides) on the way from an item (from 0) of the class `c` to the root."""
        nodes, sides = [], []
        while True:
            if (c, item) in self.singles:
                (c, side), item = self.singles[c, item], 0
            elif c in self.pairs and item < self.pairs[c][1]:
                c, side, item = self.pairs[c][0], item & 1, item >> 1
            else:
                return nodes, sides
            nodes.append(self.first[c] + item)
            sides.append(side)


def first_vectors(n: np.ndarray, rank: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Even numbers within +-0.5 / size, the same for a word in every task."""
    mix = (n.astype(np.uint64) << np.uint64(40)) ^ rank.astype(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    x = mix[:, None] * np.uint64(0xBF58476D1CE4E5B9) + np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(factor)
    return ((x >> np.uint64(11)).astype(float) / (1 << 53) - 0.5) / size


class Trainer:
    """The vectors of the words and nodes that one task has met."""

    def __init__(self, tree: Huffman, size: int, window: int, seed: int, tokens: float):
        """`tokens`: as many as a task trains on, for the falling rate."""
        self.tree, self.size, self.window, self.seed, self.tokens = tree, size, window, seed, tokens
        self.random = np.random.default_rng([seed, TaskContext.get().partitionId() if TaskContext.get() else 0])
        self.known: dict[tuple[int, int], int] = {}
        self.places: dict[int, int] = {}
        self.begin, self.length = np.empty(0, np.int64), np.empty(0, np.int64)
        self.path_nodes, self.path_sides = np.empty(0, np.int32), np.empty(0, np.int8)
        self.words, self.inner, self.done = np.empty((0, size)), np.empty((0, size)), 0

    def numbers(self, n: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Places of the words (count, rank) in this task; new ones get their path and first vector."""
        each, inverse = np.unique(np.stack([n, rank], axis=1), axis=0, return_inverse=True)
        places, new, nodes, sides, lengths = [], [], [], [], []
        classes = np.searchsorted(self.tree.counts, each[:, 0])
        for k, (word, c) in enumerate(zip(map(tuple, each.tolist()), classes.tolist())):
            at = self.known.setdefault(word, len(self.known))
            places.append(at)
            if at == len(self.words) + len(new):
                new.append(k)
                own, turns = self.tree.path(c, word[1] - 1)
                nodes += [self.places.setdefault(x, len(self.places)) for x in own]
                sides += turns
                lengths.append(len(own))
        if new:
            added = np.array(lengths, np.int64)
            self.begin = np.concatenate([self.begin, len(self.path_nodes) + np.cumsum(added) - added])
            self.length = np.concatenate([self.length, added])
            self.path_nodes = np.concatenate([self.path_nodes, np.array(nodes, np.int32)])
            self.path_sides = np.concatenate([self.path_sides, np.array(sides, np.int8)])
            self.words = np.concatenate([self.words, first_vectors(each[new, 0], each[new, 1], self.size, self.seed)])
            self.inner = np.concatenate([self.inner, np.zeros((len(self.places) - len(self.inner), self.size))])
        return np.array(places, np.int64)[inverse.ravel()]

    def train(self, sentence: np.ndarray) -> None:
        """Each token is predicted from its neighbours, up to a drawn distance of at most the window."""
        reach = self.window - self.random.integers(0, self.window, len(sentence))
        for begin in range(0, len(sentence), STEP_TOKENS):
            at = np.arange(begin, min(begin + STEP_TOKENS, len(sentence)))
            offsets = np.concatenate([np.arange(-self.window, 0), np.arange(1, self.window + 1)])
            near = at[:, None] + offsets
            pairs = (near >= 0) & (near < len(sentence)) & (np.abs(offsets) <= reach[at][:, None])
            self._step(sentence[np.broadcast_to(at[:, None], near.shape)[pairs]], sentence[near[pairs]])
            self.done += len(at)

    def _step(self, word: np.ndarray, near: np.ndarray) -> None:
        many = self.length[word]
        at = np.repeat(self.begin[word] - np.cumsum(many) + many, many) + np.arange(many.sum())
        if not len(at):
            return
        rows, row = np.unique(np.repeat(near, many), return_inverse=True)
        nodes, node = np.unique(self.path_nodes[at], return_inverse=True)
        cell, shape = row * len(nodes) + node, (len(rows), len(nodes))
        met = np.bincount(cell, minlength=shape[0] * shape[1]).reshape(shape)
        left = np.bincount(cell, 1.0 - self.path_sides[at], shape[0] * shape[1]).reshape(shape)
        own, inner = self.words[rows], self.inner[nodes]
        score = own @ inner.T
        rate = max(LEAST_RATE, RATE * (1 - self.done / (self.tokens + 1)))
        pull = np.where(np.abs(score) < MOST_SCORE, rate * (left - met / (1 + np.exp(-score))), 0.0)
        self.words[rows] += pull @ inner
        self.inner[nodes] += pull.T @ own


def word_vectors(sentences: DataFrame, tokens: str, size: int, window: int, min_count: int, seed: int, parts: int) -> DataFrame:
    """(word, vec): skip-gram vectors of the words that stand at least `min_count` times in the token arrays.

    Null arrays and null tokens are passed over; without words there are no rows.
    """
    stored = cut_lineage(sentences.select(F.col(tokens).alias("tokens")).withColumn("id", F.monotonically_increasing_id()))
    rows = token_rows(stored, F.col("tokens"), ["id"]).filter(F.col("word").isNotNull())
    counts = rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    ranked = cut_lineage(hashed_rank(counts, ["n"], ["word"], "rank", seed, digits=3).select("word", "n", "rank"))
    sizes = {r["n"]: r["words"] for r in ranked.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()}
    tree, share = Huffman(sizes), sum(n * m for n, m in sizes.items()) / parts
    looked = keyed_lookup(rows, ranked, "word", ["id", "pos"]).filter(F.col("n").isNotNull())
    ready = gather(looked, ["id"], {"n": "n", "rank": "rank"}).repartition(parts, "id").sortWithinPartitions("id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(tree, size, window, seed, share)
        for batch in batches:
            n, rank = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("n", "rank"))
            if len(n):
                ends = np.cumsum(batch.column("n").value_lengths().to_numpy(zero_copy_only=False))
                for sentence in np.split(trainer.numbers(n, rank), ends[:-1]):
                    trainer.train(sentence)
        known = np.array(list(trainer.known), np.int64).reshape(-1, 2)
        for begin in range(0, len(known), OUT_ROWS):
            some = slice(begin, begin + OUT_ROWS)
            found = [pa.array(known[some, 0]), pa.array(known[some, 1]), *(pa.array(trainer.words[some, k]) for k in range(size))]
            yield pa.RecordBatch.from_arrays(found, ["n", "rank", *(f"v{k}" for k in range(size))])

    trained = ready.select("n", "rank").mapInArrow(run, ", ".join(["n bigint", "rank bigint", *(f"v{k} double" for k in range(size))]))
    vectors = trained.groupBy("n", "rank").agg(*[F.avg(f"v{k}").alias(f"v{k}") for k in range(size)])
    return ranked.join(vectors, ["n", "rank"]).select("word", F.array(*[f"v{k}" for k in range(size)]).alias("vec"))
