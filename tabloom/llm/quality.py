"""Document quality by Bradley-Terry pairwise ranking."""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import hash_prefix, table, whole_batches
from tabloom.session import cut_lineage

FEATURES = [
    "upper_share",
    "symbol_share",
    "punctuation_share",
    "digit_share",
    "line_share",
    "bar_share",
    "repeat_share",
    "variety",
    "word_length",
    "short_words",
    "log_length",
]
ROWS_PER_LABEL = 10_000
PAIRS = 40_000
DECISION = 0.3
SEED = 7

_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_PUNCTUATION = b".,;:?'\"()-"
_SYMBOL = b"!#$%&*+/<=>@[\\]^_`{|}~"
_WINDOW = 4096


def features(text: str) -> list[float]:
    """What the score sees of one whole text; an empty text has zeros."""
    data = text.encode("utf-8", "surrogatepass")
    n = len(data)
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)

    def share(some: bytes) -> float:
        return (n - len(data.translate(None, some))) / n

    repeats = sum(map(operator.eq, words, words[1:]))
    kinds = sum(len(set(words[i : i + _WINDOW])) for i in range(0, len(words), _WINDOW))
    return [
        share(_UPPER),
        share(_SYMBOL),
        share(_PUNCTUATION),
        share(_DIGIT),
        share(b"\n"),
        share(b"|"),
        repeats / len(words),
        kinds / len(words),
        min(len(text) / len(words), 50.0),
        sum(len(w) < 3 for w in words) / len(words),
        float(np.log1p(len(words))),
    ]


def text_features(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, features): an array of doubles per row, made in one pass over the texts and without a shuffle."""
    whole_batches(docs.sparkSession, 4)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "features": [features(t) for t in frame["text"]]})

    kind = docs.schema[id_column].dataType.simpleString()
    wanted = docs.select(docs[id_column].alias("doc_id"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"))
    return wanted.mapInPandas(run, f"doc_id {kind}, features array<double>")


class PairRanker:
    """Strength w.z of a document; P(a better than b) = sigmoid(w.(z_a - z_b)), z the standardised features."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float, spread: float):
        self.centre, self.scale, self.weights, self.cut, self.spread = centre, scale, weights, cut, spread

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights

    def score_column(self, column: str, decision: float = DECISION) -> Column:
        """Score in [0, 1] as a Spark expression: `decision` exactly at the cut, rising with the strength."""
        total = F.lit(0.0)
        for k, (c, s, w) in enumerate(zip(self.centre, self.scale, self.weights)):
            z = F.least(F.greatest((F.col(column)[k] - float(c)) / float(s), F.lit(-8.0)), F.lit(8.0))
            total = total + z * float(w)
        offset = float(np.log(decision / (1 - decision)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-((total - float(self.cut)) / float(self.spread) + offset)))


def fit_pairs(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, steps: int = 300, penalty: float = 1e-3) -> PairRanker:
    """Fit on `pairs` random preference pairs (one row of each label) by Newton steps on the logistic loss of differences.

    The cut is the quantile of the strengths, over both labels, that separates
    them with the best balanced accuracy. Without rows of both labels every
    strength is zero and lies at the cut.
    """
    size = len(FEATURES)
    if not len(good) or not len(bad):
        return PairRanker(np.zeros(size), np.ones(size), np.zeros(size), 0.0, 1.0)
    rng = np.random.default_rng(SEED)
    both = np.vstack([good, bad])
    centre, scale = both.mean(0), both.std(0) + 1e-6
    z_good, z_bad = (np.clip((x - centre) / scale, -8, 8) for x in (good, bad))
    diff = z_good[rng.integers(len(good), size=pairs)] - z_bad[rng.integers(len(bad), size=pairs)]
    w = np.zeros(size)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        slope = diff.T @ (p - 1) / pairs + penalty * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / pairs + penalty * np.eye(size)
        step = np.linalg.solve(curve, slope)
        step /= max(1.0, float(np.abs(step).max()))
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    s_good, s_bad = np.sort(z_good @ w), np.sort(z_bad @ w)
    levels = np.unique(np.quantile(np.concatenate([s_good, s_bad]), np.linspace(0, 1, 1001)))
    kept_good = 1 - np.searchsorted(s_good, levels, "left") / len(s_good)
    cut_bad = np.searchsorted(s_bad, levels, "left") / len(s_bad)
    balance = kept_good + cut_bad
    best = levels[balance >= balance.max() - 1e-12]
    spread = float(np.std(np.concatenate([s_good, s_bad]))) or 1.0
    return PairRanker(centre, scale, w, float((best[0] + best[-1]) / 2), spread)


def training_rows(featured: DataFrame, labels: DataFrame, rows: int = ROWS_PER_LABEL) -> dict[int, np.ndarray]:
    """At most `rows` feature rows of each label, the first in a hash order of the ids; the bound of what reaches the driver."""
    known = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("quality"))
    joined = featured.join(known, featured["doc_id"] == known["__id"]).select("quality", "features", "doc_id")
    totals = dict(joined.groupBy("quality").count().collect())
    order = F.xxhash64("doc_id", F.lit(SEED))
    found = {}
    for label in (0, 1):
        of_label = joined.filter(F.col("quality") == label)
        some = hash_prefix(of_label, totals.get(label, 0), rows, order).orderBy(order, "doc_id", "features").limit(rows).select("features").toPandas()
        found[label] = np.array(some["features"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return found


def quality_scores(docs: DataFrame, labels: DataFrame, decision: float = DECISION, rows: int = ROWS_PER_LABEL, pairs: int = PAIRS) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per input row.

    Learned from labelled rows that are not held out: crc32 of the id as text,
    modulo 5, is not 0. Only the text enters a score. A null text counts as
    empty; all empty texts score alike. Null ids are held out and never used
    for training; null or other labels than 0 and 1 are skipped; a row that is
    repeated in either table counts as often as it stands there. Without
    training rows of both labels every score is `decision`. An empty table
    gives no rows; other columns are not looked at.
    """
    featured = cut_lineage(text_features(docs))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    sample = training_rows(featured.filter(~held), labels, rows)
    ranker = fit_pairs(sample[1], sample[0], pairs)
    score = ranker.score_column("features", decision)
    scored = featured.select("doc_id", held.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= decision).cast("int"))


def op2_bradley_terry(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {"op2_bradley_terry": op2_bradley_terry}
SQL: dict[str, str] = {}
