"""Toxic documents by multiple-instance learning over sentences.

A document is toxic when one of its sentences is. Only documents are labelled,
so the sentence scores p_s = sigmoid(w.x_s + b) are learned through the noisy-or
P = 1 - prod(1 - p_s) of each document; afterwards they locate the sentences.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import hash_prefix, table, whole_batches
from tabloom.session import cut_lineage

ROWS_PER_LABEL = 4_000
DIMENSIONS = 1 << 20
PREFIXES = (4, 5, 6, 7)
LEAST_DOCUMENTS = 5
LEAST_SIGMA = 3.0
STEPS = 200
RATE = 0.1
PENALTY = 3e-5
DECISION = 0.5
SEED = 11
KNOWN_WORDS = 200_000

_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]|[^.!?\n]+")
_ENDS = ".!?\n"


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-cased word: the word itself and the longer of its starts."""
    parts = ["=" + word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % DIMENSIONS for p in parts]


def sentence_words(text: str) -> list[list[str]]:
    """The words of each sentence, which ends with a full stop, a mark or a line; a text without words has one sentence."""
    out: list[list[str]] = [[]]
    for token in _TOKEN.findall(text.lower()):
        if token in _ENDS:
            out.append([])
        else:
            out[-1].append(token)
    return out


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class SentenceModel:
    """Weights of the hashed features, the offset of a sentence with a weighted word, and the logit of one without."""

    weights: np.ndarray
    offset: float
    plain: float

    def words(self) -> dict:
        """A dictionary that finds the weight of any word and keeps it."""
        weights = self.weights

        class Known(dict):
            def __missing__(self, word: str) -> float:
                value = self[word] = float(sum(weights[k] for k in word_features(word)))
                return value

        return Known({end: np.nan for end in _ENDS})

    def sentence_logits(self, text: str, known: dict) -> np.ndarray:
        """One logit per sentence in the order of `sentence_words`; `plain` where no word has a weight."""
        tokens = _TOKEN.findall(text.lower())
        values = np.fromiter(map(known.__getitem__, tokens), np.float64, len(tokens))
        ends = np.isnan(values)
        values[ends] = 0.0
        sentence = np.cumsum(ends)
        marked = np.bincount(sentence, weights=values != 0, minlength=1) > 0
        return np.where(marked, np.bincount(sentence, weights=values, minlength=1) + self.offset, self.plain)


def noisy_or(logits: np.ndarray) -> float:
    """1 - prod(1 - sigmoid(logit)), stable for many small and for large scores."""
    return float(-np.expm1(-_softplus(logits).sum()))


class _Bag:
    """Training documents as numbers: the word at each place, the sentence and the document it is in, and the features of each word."""

    def __init__(self, texts: list[str]):
        index: dict[str, int] = {}
        words, sizes, doc_of = array("i"), array("i"), array("i")
        for number, text in enumerate(texts):
            for sentence in sentence_words(text):
                words.extend(index.setdefault(w, len(index)) for w in sentence)
                sizes.append(len(sentence))
                doc_of.append(number)
        self.words, self.doc_of = np.array(words, np.int32), np.array(doc_of, np.int32)
        self.sentence_of = np.repeat(np.arange(len(sizes), dtype=np.int32), np.array(sizes, np.int32))
        feature, counts = array("i"), array("i")
        for word in index:
            own = word_features(word)
            feature.extend(own)
            counts.append(len(own))
        self.used, self.slot = np.unique(np.array(feature, np.int32), return_inverse=True)
        self.counts = np.array(counts, np.int64)
        self.first = np.cumsum(self.counts) - self.counts

    def slots_of(self, words: np.ndarray) -> np.ndarray:
        count = self.counts[words]
        return self.slot[np.repeat(self.first[words] - np.cumsum(count) + count, count) + np.arange(count.sum())]

    def marking(self, toxic: np.ndarray) -> np.ndarray:
        """Per feature whether toxic documents hold it more often than chance gives: LEAST_SIGMA deviations above the mean share."""
        documents, marked = np.zeros(len(self.used)), np.zeros(len(self.used))
        ends = np.searchsorted(self.doc_of[self.sentence_of], np.arange(len(toxic) + 1))
        for number, (begin, end) in enumerate(zip(ends[:-1], ends[1:])):
            held = np.unique(self.slots_of(np.unique(self.words[begin:end])))
            documents[held] += 1
            marked[held] += toxic[number]
        share = toxic.mean()
        sigma = (marked - share * documents) / np.sqrt(share * (1 - share) * np.maximum(documents, 1))
        return (documents >= LEAST_DOCUMENTS) & (sigma >= LEAST_SIGMA)


def fit_sentences(texts: list[str], toxic: np.ndarray, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> SentenceModel:
    """Maximum likelihood of document labels under the noisy-or, by full gradient steps with adapted step sizes.

    Both labels weigh the same. Features of fewer than LEAST_DOCUMENTS documents,
    or that toxic documents do not hold markedly more often, are left at zero.
    Without documents of both labels every weight is zero and every document
    scores near 0.
    """
    weights = np.zeros(DIMENSIONS)
    if not len(texts) or toxic.min() == toxic.max() or not any(map(_TOKEN.search, texts)):
        return SentenceModel(weights.astype(np.float32), -10.0, -10.0)
    bag = _Bag(texts)
    keep = bag.marking(toxic)
    used = bag.used[keep]
    number = np.cumsum(keep) - 1
    kept = keep[bag.slot]
    owner, slot = np.repeat(np.arange(len(bag.counts)), bag.counts)[kept], number[bag.slot[kept]]
    hits = np.isin(bag.words, owner)
    known, words = np.unique(bag.words[hits], return_inverse=True)
    owner = np.searchsorted(known, owner)
    marked, sentence_of = np.unique(bag.sentence_of[hits], return_inverse=True)
    plain = np.bincount(bag.doc_of, minlength=len(texts)) - np.bincount(bag.doc_of[marked], minlength=len(texts))
    doc_of = bag.doc_of[marked]

    w, b, c = np.zeros(len(used)), -4.0, -8.0
    m, v = np.zeros(len(used) + 2), np.zeros(len(used) + 2)
    share = toxic.mean()
    weight_of = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share)) / len(texts)
    for step in range(1, steps + 1):
        value = np.bincount(owner, weights=w[slot], minlength=len(known))
        z = np.bincount(sentence_of, weights=value[words], minlength=len(doc_of)) + b
        p = _sigmoid(z)
        total = np.bincount(doc_of, weights=_softplus(z), minlength=len(texts)) + plain * _softplus(np.array(c))
        factor = np.where(toxic == 1, -1 / np.expm1(np.minimum(total, 700)), 1.0) * weight_of
        slope = factor[doc_of] * p
        per_word = np.bincount(words, weights=slope[sentence_of], minlength=len(known))
        g = np.bincount(slot, weights=per_word[owner], minlength=len(used)) + penalty * w
        g = np.concatenate([g, [slope.sum(), (factor * plain).sum() * _sigmoid(c)]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b, c = w - move[:-2], b - move[-2], c - move[-1]
    weights[used] = w
    return SentenceModel(weights.astype(np.float32), float(b), float(c))


def held_out(column: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; null ids are held out."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_texts(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_LABEL) -> tuple[list[str], np.ndarray]:
    """Whole texts and labels of at most `rows` documents of each label that are not held out, the first by a hash of the id.

    Only ids are shuffled to choose them; the texts come by a broadcast of at
    most 2 * `rows` ids.
    """
    flag = F.col("toxic")
    known = labels.select(F.col("doc_id").alias("id"), "toxic").filter(flag.isin(0, 1) & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max(flag).cast("int").alias("toxic"))
    known = cut_lineage(known.join(docs.select(F.col("id").alias("__id")).distinct(), F.col("id") == F.col("__id"), "left_semi"))
    totals = dict(known.groupBy("toxic").count().collect())
    order = F.xxhash64("id", F.lit(SEED))
    chosen = None
    for label in (0, 1):
        some = hash_prefix(known.filter(flag == label), totals.get(label, 0), rows, order).orderBy(order, "id").limit(rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    picked = docs.join(F.broadcast(cut_lineage(chosen)), "id").select("id", "text", "toxic").toPandas()
    picked = picked.sort_values(["id", "text"], kind="stable")
    return picked["text"].tolist(), picked["toxic"].to_numpy(np.int64)


def score_sentences(docs: DataFrame, model: SentenceModel, least: float = DECISION) -> DataFrame:
    """(id, score, sentences) of docs (id, text); sentences: start, length and score of each one that scores `least` or more."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shipped.value.words()
        for frame in frames:
            scores, located = [], []
            for text in frame["text"]:
                if len(known) > KNOWN_WORDS:
                    known = shipped.value.words()
                logits = shipped.value.sentence_logits(text, known)
                scores.append(noisy_or(logits))
                p = _sigmoid(logits)
                found = []
                if (p >= least).any():
                    for k, m in enumerate(_SENTENCE.finditer(text)):
                        if p[k] >= least:
                            found.append({"start": m.start(), "length": m.end() - m.start(), "score": float(p[k])})
                located.append(found)
            yield pd.DataFrame({"id": frame["id"], "score": scores, "sentences": located})

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInPandas(run, f"id {kind}, score double, sentences array<struct<start:int,length:int,score:double>>")


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, decision: float = DECISION, rows: int = ROWS_PER_LABEL, steps: int = STEPS
) -> DataFrame:
    """(doc_id, held_out, score, predicted, sentences): one row per input row.

    Learned from labelled documents that are not held out, at most `rows` of
    each label. Only the text enters a score. `sentences` locates what scores
    `decision` or more alone: start and length in characters, and the score; a
    document may pass by several weaker sentences and have none listed.

    Sentences without any word that has a weight share one small score of their
    own, so that a long clean text stays far below `decision`. A null text counts
    as empty; an empty text is one such sentence. Rows with a
    null id are held out, scored, and never used for training. Null or other
    labels than 0 and 1 are skipped; of several labels of one document 1 counts.
    A repeated row is scored each time. Without training rows of both labels
    every document scores near 0. An empty table gives no rows; other columns
    are not looked at.
    """
    whole_batches(docs.sparkSession, 8)
    wanted = docs.select(docs["doc_id"].alias("id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    model = fit_sentences(*training_texts(wanted, labels, rows), steps)
    scored = score_sentences(wanted, model, decision)
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= decision).cast("int").alias("predicted"),
        "sentences",
    )


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {"op11_toxicity": op11_toxicity}
SQL: dict[str, str] = {}
