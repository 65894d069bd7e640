"""Periodic runs of words by seed-and-extend on diagonals.

A run of smallest period q and length at least max(LEAST, 2q) is a stretch of
at least max(LEAST - q, q) words that equal the word q places later: a stretch
on the diagonal of lag q. Lags are worked through in classes [low, high); in a
class every such stretch holds a whole k-gram that starts at a multiple of k,
where 2k - 1 is at most the guaranteed overlap. So the k-grams are indexed, and
each one at a multiple of k is paired with its occurrences in the same document
at the lags of the class: at most two pairs per word in a class, whatever the
text repeats. Per lag, a pair that lies before the furthest word covered by an
extension is not extended again, nor is a pair inside a run whose period divides
the lag, where no new smallest period can be found.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import table, whole_batches

LEAST = 12
PAIRS = 1 << 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lag_classes(longest: int, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(k, low, high): k-grams that serve the lags low <= lag < high, up to half of the `longest` document.

    The guaranteed overlap of a lag is max(least - lag, lag). The first class
    holds the small lags, for which it is about half of `least`; later ones
    double the lag and with it the k-gram.
    """
    low, high, overlap = 1, least // 2 + 2, (least + 1) // 2
    classes = []
    while 2 * low <= longest:
        classes.append(((overlap + 1) // 2, low, high))
        low, high, overlap = high, 2 * high, high
    return classes


class Grams:
    """Exact names of the k-grams of a word sequence: equal names, equal k-grams of the same document.

    A longer k-gram is named by the pair of the two overlapping shorter ones
    that cover it. Positions whose name occurs once are dropped (-1), so that
    little is left of ordinary text after a few steps.
    """

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        self.size = len(words)
        self.length = 1
        self.names = self._named(np.arange(self.size), doc * (int(words.max(initial=0)) + 1) + words)

    def _named(self, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        names = np.full(self.size, -1, np.int64)
        _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
        again = count[name] > 1
        names[at[again]] = name[again]
        return names

    def grow(self, k: int) -> None:
        """Name the k-grams, in steps that at most double the length."""
        while self.length < k:
            shift = min(self.length, k - self.length)
            at = np.flatnonzero(self.names[: max(0, self.size - shift)] >= 0)
            at = at[self.names[at + shift] >= 0]
            self.names = self._named(at, self.names[at] * (self.size + 1) + self.names[at + shift])
            self.length += shift

    def pairs(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(position, lag): k-grams at multiples of k with each later occurrence at a lag in [low, high), in bounded portions."""
        at = np.flatnonzero(self.names >= 0)
        if not len(at):
            return
        index = np.sort(self.names[at] * (self.size + 1) + at)
        seeds = at[at % self.length == 0]
        key = self.names[seeds] * (self.size + 1) + seeds
        limit = (self.names[seeds] + 1) * (self.size + 1)
        first = np.searchsorted(index, key + low)
        count = np.searchsorted(index, np.minimum(key + high, limit)) - first
        some = count > 0
        seeds, first, count = seeds[some], first[some], count[some]
        ends = np.cumsum(count)
        start = 0
        while start < len(seeds):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
            n = count[start:stop]
            at = np.repeat(first[start:stop], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            left = np.repeat(seeds[start:stop], n)
            yield left, index[at] % (self.size + 1) - left
            start = stop


def _forward(words: np.ndarray, at: int, lag: int) -> int:
    """First position from `at` on whose word differs from the one `lag` later."""
    width, last = 16, len(words) - lag
    while at < last:
        stop = min(at + width, last)
        differs = words[at:stop] != words[at + lag : stop + lag]
        found = int(differs.argmax())
        if differs[found]:
            return at + found
        at, width = stop, width * 2
    return last


def _backward(words: np.ndarray, at: int, lag: int) -> int:
    """Start of the stretch of equal words that ends before `at`."""
    width = 16
    while at > 0:
        start = max(0, at - width)
        differs = words[start:at] != words[start + lag : at + lag]
        found = int(differs[::-1].argmax())
        if differs[len(differs) - 1 - found]:
            return at - found
        at, width = start, width * 2
    return 0


def _primitive(root: np.ndarray) -> bool:
    """Whether no shorter period that divides its length generates `root`."""
    n, rest, factor = len(root), len(root), 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            part = n // factor
            if (root[: n - part] == root[part:]).all():
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def runs_of(words: np.ndarray, doc: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs; `words` are word numbers and `doc` the number of the document at each place.

    Between two documents there must be a place with a word number of its own.
    """
    if not len(words):
        return np.empty((0, 3), np.int64)
    found: list[tuple[int, int, int]] = []
    grams = Grams(words, doc)
    reach = np.zeros(len(words), np.int64)  # how far the run goes that covers a place furthest, and its period
    period = np.ones(len(words), np.int64)
    for k, low, high in lag_classes(int(np.bincount(doc).max()), least):
        grams.grow(k)
        fresh = len(found)
        covered: dict[int, int] = {}  # per lag, the furthest word that an extension has covered
        for left, lag in grams.pairs(low, high):
            open_ = (reach[left] < left + lag) | (lag % period[left] != 0)
            left, lag = left[open_], lag[open_]
            order = np.lexsort((left, lag))
            left, lag = left[order], lag[order]
            edges = np.flatnonzero(np.diff(lag, prepend=0))
            for begin, stop in zip(edges.tolist(), [*edges[1:].tolist(), len(lag)]):
                q, own = int(lag[begin]), left[begin:stop]
                here = int(np.searchsorted(own, covered.get(q, 0)))
                while here < len(own):
                    at = int(own[here])
                    first, end = _backward(words, at, q), _forward(words, at, q)
                    covered[q] = end
                    if end - first >= max(least - q, q) and _primitive(words[first : first + q]):
                        found.append((first, end + q - first, q))
                    here = int(np.searchsorted(own, end))
        for start, length, q in found[fresh:]:
            part = slice(start, start + length)
            more = reach[part] < start + length
            reach[part][more] = start + length
            period[part][more] = q
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _numbered(texts: list[str]) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, word numbers with one place of its own after each text, document at each place, first places)."""
    split = [_WORD.findall(t) for t in texts]
    sizes = np.array([len(w) + 1 for w in split], np.int64)
    start = np.cumsum(sizes) - sizes
    known: dict[str, int] = {}
    numbers = np.empty(int(sizes.sum()), np.int64)
    for words, begin in zip(split, start.tolist()):
        numbers[begin : begin + len(words)] = [known.setdefault(w, len(known)) for w in words]
    numbers[start + sizes - 1] = len(known) + np.arange(len(split))
    return split, numbers, np.repeat(np.arange(len(split)), sizes), start


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed): one row per input row; runs are (start, length, period) by start, then period.

    A run is a stretch of words with smallest period q and a length of at least
    max(`least`, 2q) that no neighbouring word extends with that period. In
    `collapsed` the words that some run holds after its first q words are
    dropped and the others joined by one blank. Words are what blanks, tabs and
    line ends separate, compared as they are.

    A null text counts as empty; an empty text has no runs and collapses to an
    empty text. Rows with a null id and repeated rows are treated like others,
    ids may be of any type; other columns are not looked at; an empty table gives
    no rows. A text is worked on whole by the task that reads it, nothing is
    shuffled.
    """
    whole_batches(docs.sparkSession, 4)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            split, numbers, doc, first = _numbered(frame["text"].tolist())
            runs = runs_of(numbers, doc, least)
            change = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 0] + runs[:, 1], -1)
            gone = np.cumsum(change[:-1]) > 0
            owner = doc[runs[:, 0]]
            edges = np.searchsorted(owner, np.arange(len(split) + 1))
            listed, collapsed = [], []
            for k, words in enumerate(split):
                begin = int(first[k])
                own = runs[edges[k] : edges[k + 1]]
                listed.append([{"start": s - begin, "length": n, "period": q} for s, n, q in own.tolist()])
                if len(own):
                    drop = gone[begin : begin + len(words)]
                    words = [w for w, d in zip(words, drop.tolist()) if not d]
                collapsed.append(" ".join(words))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "runs": listed, "collapsed": collapsed})

    kind = docs.schema[id_column].dataType.simpleString()
    wanted = docs.select(docs[id_column].alias("doc_id"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"))
    return wanted.mapInPandas(run, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of each document and digests of its runs and of its collapsed text, from `periodic_runs`."""
    longest = F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))[0]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.when(F.size("runs") > 0, longest).alias("best"), lines.alias("lines"), "collapsed")
    length = -F.col("best.less")
    return best.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by crc32 h of its id is made periodic from a word on; words joined by one blank.

    With g = h div 10 and n words, the words from a = g mod n on repeat the
    first p = 1 + (n - a) div (3 + g mod 8) of them.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    cut = docs.select("doc_id", "text", chosen.alias("chosen"), F.floor(h / 10).cast("bigint").alias("g"), F.when(chosen, words).alias("words"))
    n = F.size("words").cast("bigint")
    cut = cut.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("left", n - F.col("a"))
    cut = cut.withColumn("p", 1 + F.floor(F.col("left") / (3 + F.col("g") % 8)))

    def part(column: Column, begin: Column, size: Column) -> Column:
        return F.slice(column, begin.cast("int"), size.cast("int"))

    root = part(F.col("words"), F.col("a") + 1, F.col("p"))
    tail = part(F.flatten(F.array_repeat(root, F.ceil(F.col("left") / F.col("p")).cast("int"))), F.lit(1), F.col("left"))
    made = F.array_join(F.concat(part(F.col("words"), F.lit(1), F.col("a")), tail), " ")
    return cut.select("doc_id", F.when(F.col("left").isNotNull() & F.col("chosen"), made).otherwise(F.col("text").cast("string")).alias("text"))


def op13_periodic(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(periodic_runs(planted(table(spark, folder, "documents").select("doc_id", "text"))))


QUERIES = {"op13_periodic": op13_periodic}
SQL: dict[str, str] = {}
