"""Jaccard join of word n-gram sets by chosen paths.

A set is represented by T min-wise samples of its shingles. From a node of the
tree, sets go down along one or two sampled tokens of theirs, chosen by the
node alone, so that a pair of similarity J shares each branch with chance J.
Small buckets are compared pair by pair; larger ones split again, down to the
last level. The runs repeat until a pair at the limit is met with the wanted
chance.

What is left above BLOCK rows in a bucket of the last level is compared with
pivots only: a few drawn ones, then all rows that are near to none of them,
then all rows that are outside the largest class of the bucket. A pair of rows
that met no pivot is in one class already, so nothing is missed, and the rows
that are moved and made grow with the bucket and not with its square.

What the samples call similar enough is then compared exactly, within the
classes found, by what a set has more or less than the first set of its class.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import counted, table, whole_batches
from tabloom.llm.components import components
from tabloom.llm.heavy import group_winners
from tabloom.session import cut_lineage

WORDS = 5
SIMILARITY = 0.8
SAMPLES = 64
LEAF = 48
DEPTH = 4
BLOCK = 1024
EXACT_BLOCK = 2048
PIVOTS = 32
RECALL = 0.9999
SPLIT = " \t\n\r\f\v"
KNOWN_WORDS = 100_000
BROADCAST_SETS = 1_000_000
BATCH_MEGABYTES = 4

_RNG = np.random.default_rng(20240501)
_FACTORS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class _WordHashes(dict):
    """64-bit hashes of words; belongs to one task and starts anew when it holds KNOWN_WORDS."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def words_of(text: str) -> list[str]:
    """What ASCII white space separates, A-Z lower-cased."""
    text = text.translate(_LOWER) if not text.isascii() else text.lower()
    for space in SPLIT[1:]:
        text = text.replace(space, " ")
    return [w for w in text.split(" ") if w]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str, words: int = WORDS, known: _WordHashes | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `words` words; fewer words are one run, no words no run."""
    found = words_of(text)
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map((known if known is not None else _WordHashes()).__getitem__, found), np.uint64, len(found))
    runs = max(1, len(h) - words + 1)
    total = np.full(runs, min(len(h), words), np.uint64)
    for k in range(min(words, len(h))):
        total = _mix(total * np.uint64(0xD6E8FEB86659FD93) + h[k : k + runs])
    return np.unique(total)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """T min-wise samples, 32 bits each, of a set that is not empty."""
    best = np.full(SAMPLES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(0, len(hashes), 1024):
        best = np.minimum(best, (hashes[k : k + 1024, None] * _FACTORS + _OFFSETS).min(axis=0))
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def text_sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(id, key, size, samples) of docs (id, text); key is a digest of the whole set, null for a text without words."""
    whole_batches(docs.sparkSession, BATCH_MEGABYTES)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _WordHashes()
        for frame in frames:
            keys, sizes, samples = [], [], []
            for text in frame["text"]:
                hashes = shingle_set(text, words, known)
                sizes.append(len(hashes))
                keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                samples.append(sketch(hashes) if len(hashes) else None)
            yield pd.DataFrame({"id": frame["id"], "key": keys, "size": sizes, "samples": samples})

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInPandas(run, f"id {kind}, key binary, size int, samples array<int>")


def survival(similarity: float, depth: int, limit: float = SIMILARITY) -> float:
    """Chance that a pair of this similarity shares a bucket of level `depth` in one run that branches for `limit`."""
    second = 1 / limit - 1
    chance = 1.0
    for _ in range(depth):
        meets = similarity * chance
        chance = (1 - second) * meets + second * (1 - (1 - meets) ** 2)
    return chance


def missed(similarity: float, runs: int, depth: int = DEPTH, limit: float = SIMILARITY) -> float:
    """Chance that a pair of this similarity is lost although all its buckets go down to the last level.

    The runs share the samples, so this is the mean over the number of samples
    that are equal; too few of them lose the pair in any run.
    """
    total = 0.0
    for equal in range(SAMPLES + 1):
        share = math.comb(SAMPLES, equal) * similarity**equal * (1 - similarity) ** (SAMPLES - equal)
        found = equal >= least_equal(limit)
        total += share * ((1 - survival(equal / SAMPLES, depth, limit)) ** runs if found else 1.0)
    return total


def least_equal(similarity: float) -> int:
    """Equal samples that a pair must have to be compared exactly: four standard deviations under the similarity."""
    return math.floor(SAMPLES * similarity - 4 * math.sqrt(SAMPLES * similarity * (1 - similarity)))


def runs_for(recall: float, similarity: float = SIMILARITY, depth: int = DEPTH) -> int:
    """Runs that would reach the recall if their samples were independent; `missed` gives what they reach."""
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(similarity, depth, similarity)))


def _down(path: Column, samples: Column, similarity: float) -> Column:
    """The paths of a set one level below `path`: one token, and with chance 1/similarity - 1 a second."""
    def along(draw: int) -> Column:
        at = F.pmod(F.xxhash64(path, F.lit(draw)), F.lit(SAMPLES)).cast("int")
        return F.xxhash64(path, at, F.get(samples, at))

    scale = 1_000_000
    twice = F.pmod(F.xxhash64(path, F.lit(-1)), F.lit(scale)) < int((1 / similarity - 1) * scale)
    return F.explode(F.when(twice, F.array_distinct(F.array(along(1), along(2)))).otherwise(F.array(along(1))))


def buckets(sets: DataFrame, similarity: float, runs: int, depth: int = DEPTH, leaf: int = LEAF) -> DataFrame:
    """(path, rep, n): the members of every bucket that is compared, n its size. `sets` is a stored (rep, samples)."""
    roots = sets.select("rep", "samples", F.explode(F.array(*[F.xxhash64(F.lit(run)) for run in range(runs)])).alias("path"))
    done = None
    for level in range(1, depth + 1):
        reached = roots.select("rep", _down(F.col("path"), F.col("samples"), similarity).alias("path"))
        if level > 1:
            reached = reached.distinct()
        counts = reached.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        met = cut_lineage(reached.join(counts, "path").select("path", "rep", "n"))
        ready = met if level == depth else met.filter(F.col("n") <= leaf)
        done = ready if done is None else done.unionByName(ready)
        roots = met.filter(F.col("n") > leaf).select("rep", "path").join(sets.select("rep", "samples"), "rep")
    return done


def _stars(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the smallest index of its component."""
    root = np.arange(len(linked))
    while True:
        least = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1))
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _fits(size: np.ndarray, other: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs can reach the similarity by their sizes."""
    return np.minimum.outer(size, other) >= similarity * np.maximum.outer(size, other) - 1e-9


def _similar(own: np.ndarray, size: np.ndarray, other: np.ndarray, other_size: np.ndarray, similarity: float) -> np.ndarray:
    """Matrix of what the samples call similar; rows of bytes, compared in portions."""
    linked = _fits(size, other_size, similarity)
    least = least_equal(similarity)
    for k in range(0, len(own), 64):
        some = np.flatnonzero(linked[k : k + 64].any(axis=1)) + k
        if len(some):
            linked[some] &= (own[some, None, :] == other[None, :, :]).sum(axis=2, dtype=np.uint8) >= least
    return linked


def _grouped(members: DataFrame, *keys: str) -> DataFrame:
    """One row per group with its rows as flat arrays (rep, size, pivot, bytes)."""
    row = F.struct("rep", "size", "pivot", "bytes")
    grouped = members.groupBy(*keys).agg(F.collect_list(row).alias("m"))
    return grouped.select(
        keys[0], F.col("m.rep").alias("rep"), F.col("m.size").alias("size"), F.col("m.pivot").alias("pivot"), F.flatten("m.bytes").alias("bytes")
    )


def _small_buckets(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b): a star per connected part of each bucket, whose rows meet in one task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for rep, size, data in zip(frame["rep"], frame["size"], frame["bytes"]):
                order = np.argsort(rep, kind="stable")
                rep, size, own = rep[order], size[order], data.reshape(len(rep), SAMPLES)[order]
                linked = _similar(own, size, own, size, similarity)
                np.fill_diagonal(linked, False)
                if linked.any():
                    root = _stars(linked)
                    moved = root != np.arange(len(root))
                    a.append(rep[moved])
                    b.append(rep[root[moved]])
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return _grouped(members.withColumn("pivot", F.lit(False)), "path").mapInPandas(run, "a bigint, b bigint")


def against_pivots(members: DataFrame, similarity: float, block: int) -> DataFrame:
    """(path, rep, near): the smallest pivot that a row is similar to, or null; and near pivots of one row with each other.

    `members` has (path, rep, n, size, bytes, pivot). The rows of a bucket are
    dealt into chunks of about `block`, the pivots are copied to every chunk. A
    pivot is near to itself.
    """
    chunks = F.ceil(F.col("n") / block).cast("int")
    own = members.withColumn("chunk", F.pmod(F.xxhash64("rep", "path"), chunks).cast("int")).withColumn("pivot", F.lit(False))
    copies = members.filter("pivot").withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    columns = ["path", "chunk", "rep", "size", "bytes", "pivot"]
    met = _grouped(own.select(*columns).unionByName(copies.select(*columns)), "path", "chunk")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, rep, size, pivot, data in zip(frame["path"], frame["rep"], frame["size"], frame["pivot"], frame["bytes"]):
                data, pivot = data.reshape(len(rep), SAMPLES), pivot.astype(bool)
                order = np.flatnonzero(pivot)[np.argsort(rep[pivot], kind="stable")]
                rows, tops = rep[~pivot], rep[order]
                linked = _similar(data[~pivot], size[~pivot], data[order], size[order], similarity) | (rows[:, None] == tops[None, :])
                some = linked.any(axis=1) if len(tops) else np.zeros(len(rows), bool)
                first = linked.argmax(axis=1) if len(tops) else np.zeros(len(rows), int)
                joined = np.arange(len(tops))  # per pivot the smallest that a row of the chunk has in common with it
                for k in np.flatnonzero(some):
                    near = np.flatnonzero(linked[k])
                    if len(near) > 1:
                        joined[near] = np.minimum(joined[near], joined[near].min())
                for k in range(len(joined)):
                    joined[k] = joined[joined[k]]
                moved = joined != np.arange(len(joined))
                near = pd.array(np.where(some, tops[first] if len(tops) else 0, 0), "Int64")
                near[~some] = pd.NA
                yield pd.DataFrame({"path": path, "rep": rows, "near": near})
                yield pd.DataFrame({"path": path, "rep": tops[moved], "near": pd.array(tops[joined[moved]], "Int64")})

    return met.mapInPandas(run, "path bigint, rep bigint, near bigint")


def _links(near: DataFrame) -> DataFrame:
    return near.filter("near <> rep").select(F.col("rep").alias("a"), F.col("near").alias("b")).distinct()


def _large_buckets(members: DataFrame, similarity: float, block: int, pivots: int) -> DataFrame:
    """(a, b): links that connect what is similar in each bucket of any size; `members` is stored and has (path, rep, n, size, bytes)."""
    drawn = F.xxhash64("path", "rep", F.lit(1)) < (F.lit(2.0**64) * F.least(F.lit(1.0), pivots / F.col("n")) - 2.0**63)
    first = cut_lineage(against_pivots(members.withColumn("pivot", drawn), similarity, block))
    alone = first.groupBy("path", "rep").agg(F.max("near").alias("near")).filter("near IS NULL").select("path", "rep", F.lit(True).alias("pivot"))
    alone = cut_lineage(alone)
    open_ = members.join(alone.select("path").distinct(), "path", "left_semi").join(alone, ["path", "rep"], "left")
    second = cut_lineage(against_pivots(open_.withColumn("pivot", F.coalesce("pivot", F.lit(False))), similarity, block))
    links = cut_lineage(_links(first).unionByName(_links(second)))

    roots = components(links)
    placed = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    counts = placed.groupBy("path", "root").agg(F.count(F.lit(1)).alias("k"))
    largest = counts.groupBy("path").agg(F.max_by("root", F.struct("k", "root")).alias("top"), F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    third = cut_lineage(placed.join(largest, "path").withColumn("pivot", F.col("root") != F.col("top")).select("path", "rep", "n", "size", "bytes", "pivot"))
    return links.unionByName(_links(against_pivots(third, similarity, block)))


def sampled_links(members: DataFrame, similarity: float, block: int | None = None, pivots: int | None = None) -> DataFrame:
    """(a, b): links that connect what the samples call similar in each bucket; stars, not all pairs.

    `members` has (path, rep, size, samples, n). A pair passes when its share
    of equal samples is at most four standard deviations under the similarity.
    """
    block, pivots = block or BLOCK, pivots or PIVOTS
    packed = F.transform(F.col("samples"), lambda s: (F.pmod(s, F.lit(256)) - 128).cast("byte"))
    narrow = members.select("path", "rep", "n", "size", packed.alias("bytes"))
    small = _small_buckets(narrow.filter(F.col("n") <= block), similarity)
    large = cut_lineage(narrow.filter(F.col("n") > block))
    if large.isEmpty():
        return small.distinct()
    return small.unionByName(_large_buckets(large, similarity, block, pivots)).distinct()


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes; only hashes that two sets have take part."""
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    common = counts[inverse] > 1
    column = (np.cumsum(counts > 1) - 1)[inverse[common]]
    owner, width = owner[common], int((counts > 1).sum())
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    for start in range(0, width, 8192):
        low, high = np.searchsorted(column, [start, start + 8192])
        part = np.zeros((len(sets), min(8192, width - start)), np.float32)
        part[owner[low:high], column[low:high] - start] = 1
        total += part @ part.T
    return total


def differences(members: DataFrame, firsts: DataFrame, similarity: float) -> DataFrame:
    """(root, rep, size, less, whole, core, more): each set of a class as its difference from the first set of the class.

    `members` has (root, rep, hashes), `firsts` its rows with rep = root. `whole`
    is the size of the first set, `less` how many of its hashes a set lacks, `more` the lacking and the
    additional hashes together. A set is of the core when its distance from the
    first is at most half of what links two sets: by the triangle inequality of
    the Jaccard distance all sets of the core are linked with each other.
    """
    first = firsts.select("root", F.col("hashes").alias("first"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for root, rep, data, base in zip(frame["root"], frame["rep"], frame["hashes"], frame["first"]):
                own, top = np.frombuffer(data, np.uint64), np.frombuffer(base, np.uint64)
                more = np.setxor1d(own, top, assume_unique=True)
                less = (len(more) + len(top) - len(own)) // 2
                both = len(top) - less
                core = 2 * len(more) <= (1 - similarity) * (len(own) + len(top) - both) * (1 - 1e-9)
                rows.append((root, rep, len(own), less, len(top), core, more.tobytes()))
            yield pd.DataFrame(rows, columns=["root", "rep", "size", "less", "whole", "core", "more"])

    kinds = "root bigint, rep bigint, size int, less int, whole int, core boolean, more binary"
    return members.select("root", "rep", "hashes").join(first, "root").mapInPandas(run, kinds)


def exact_links(members: DataFrame, similarity: float, block: int | None = None) -> DataFrame:
    """(rep, root, n_links) per member and block: its exact links there, and the smallest member they connect it to.

    `members` is the stored frame of `differences`. Sets of the core of a class
    are linked with each other without a comparison; every other pair of a class
    meets in exactly one pair of blocks of about `block` sets, of which only the
    differences are moved. No pair is written out.
    """
    block = block or EXACT_BLOCK
    sizes = members.groupBy("root").agg(F.count_if("core").alias("n_core"), F.count_if(~F.col("core")).alias("n_far"))
    known = members.join(counted(sizes, BROADCAST_SETS), "root")
    cores, fars = F.ceil(F.col("n_core") / block).cast("int"), F.ceil(F.col("n_far") / block).cast("int")
    spot = F.xxhash64("rep", "root")
    part = F.when(F.col("core"), F.pmod(spot, cores)).otherwise(cores + F.pmod(spot, fars)).cast("int")
    others = F.sequence(F.when(F.col("core"), cores).otherwise(0), cores + fars - 1)
    placed = known.filter("n_far > 0").withColumn("part", part).withColumn("other", F.explode(others))
    placed = placed.select("root", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), F.struct("rep", "part", "size", "less", "whole", "core", "more").alias("row"))
    grouped = placed.groupBy("root", "a", "b").agg(F.collect_list("row").alias("m"))
    flat = grouped.select((F.col("a") == F.col("b")).alias("alone"), *[F.col(f"m.{c}").alias(c) for c in ("rep", "part", "size", "less", "whole", "core", "more")])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for alone, rep, part, size, less, whole, core, more in frame.itertuples(index=False, name=None):
                order = np.argsort(rep, kind="stable")
                rep, part, size, less, core = rep[order], part[order], size[order], less[order].astype(np.int64), core[order].astype(bool)
                linked = _fits(size, size, similarity) & ~np.logical_and.outer(core, core)
                np.fill_diagonal(linked, False)
                if not alone:  # also when one of the two blocks is empty
                    linked &= part[:, None] != part[None, :]
                if linked.any():
                    both = whole[0] - less[:, None] - less[None, :] + _shared([np.frombuffer(more[k], np.uint64) for k in order])
                    linked &= both >= similarity * (size[:, None].astype(np.int64) + size[None, :] - both) - 1e-9
                yield pd.DataFrame({"rep": rep, "root": rep[_stars(linked)], "n_links": linked.sum(axis=1)})

    met = flat.mapInPandas(run, "rep bigint, root bigint, n_links bigint")
    sure = known.filter("core AND n_core > 1").select("rep", "root", (F.col("n_core") - 1).alias("n_links"))
    return met.unionByName(sure)


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    words: int = WORDS,
    recall: float = RECALL,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, rep_id, n_copies, class_id, n_links): one row per input row.

    Two texts are linked when the Jaccard similarity of their sets of word
    n-grams is at least `similarity`. rep_id is the smallest id with the same
    set and n_copies how many rows have it; n_links counts the other sets that
    are linked with it; class_id is the smallest id of all that links connect.

    A null text counts as empty; a text without words has no n-grams, links
    with nothing and is its own class. A text of fewer words than an n-gram has
    one, its words. Rows with a null id are left out; a repeated row counts as
    a copy. Other columns are not looked at; an empty table gives no rows.
    Ids must be integers.
    """
    wanted = docs.select(docs[id_column].cast("bigint").alias("id"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"))
    wanted = wanted.filter(F.col("id").isNotNull())
    stored = cut_lineage(text_sketches(wanted, words))
    copies = cut_lineage(group_winners(stored.filter(F.col("key").isNotNull()).select("id", "key"), F.min))
    reps = copies.filter("id = keep_id").select("id", "key").distinct()
    sets = stored.join(reps, ["id", "key"]).dropDuplicates(["id", "key"]).select(F.col("id").alias("rep"), "key", "size", "samples")
    sets = cut_lineage(sets.dropDuplicates(["rep"]))
    met = buckets(sets, similarity, runs_for(recall, similarity)).join(sets.select("rep", "size", "samples"), "rep")
    classes = components(sampled_links(met, similarity))

    keyed = counted(sets.join(classes.withColumnRenamed("node", "rep"), "rep").select("rep", "key", "root"), BROADCAST_SETS)

    def whole_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _WordHashes()
        for frame in frames:
            hashes = [shingle_set(t, words, known) for t in frame["text"]]
            keys = [hashlib.blake2b(h.tobytes(), digest_size=16).digest() == k for h, k in zip(hashes, frame["key"])]
            done = frame[["root", "rep"]].assign(hashes=[h.tobytes() for h in hashes])
            yield done[np.array(keys, bool)]

    texts = wanted.join(keyed, wanted["id"] == keyed["rep"]).select("root", "rep", "key", "text")
    exact, firsts = (t.mapInPandas(whole_sets, "root bigint, rep bigint, hashes binary").dropDuplicates(["rep"]) for t in (texts, texts.filter("rep = root")))
    found = cut_lineage(exact_links(cut_lineage(differences(exact, firsts, similarity)), similarity).groupBy("rep", "root").agg(F.sum("n_links").alias("n_links")))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("n_links").alias("n_links")).filter("n_links > 0")
    facts = cut_lineage(links.join(roots.withColumnRenamed("node", "rep"), "rep").select(F.col("rep").alias("keep_id"), "n_links", "root"))
    of_sets = copies.join(facts, "keep_id", "left").select(
        F.col("id").alias("doc_id"),
        F.col("keep_id").alias("rep_id"),
        F.col("group_size").alias("n_copies"),
        F.coalesce("root", "keep_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    own = F.col("id")
    empty = stored.filter(F.col("key").isNull()).select(
        own.alias("doc_id"), own.alias("rep_id"), F.lit(1).cast("bigint").alias("n_copies"), own.alias("class_id"), F.lit(0).cast("bigint").alias("n_links")
    )
    return of_sets.unionByName(empty)


def op6_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


QUERIES = {"op6_ngram_join": op6_ngram_join}
SQL: dict[str, str] = {}
