"""Tag scores learned by maximum likelihood: a linear chain over hashed token features.

The score of a tagging is the sum of a weight per (token feature, tag) and per
(tag, next tag). Sums over all taggings come from a forward and a backward fold
inside each sentence, so a step of the fit is one pass over stored sentences
that adds up, map-side first, the expected less the observed count of each
weight. Only these sums, as many as there are weights, reach the driver, where
L-BFGS picks the next weights. The passes of a fit read Arrow batches and fold
many sentences at once, as the marginals do; `count_differences` has the same
sums as expressions.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from tabloom.operators.sequence import _add, _first, _lse, log_partition, path_score
from tabloom.session import cut_lineage

FEATURES = 1 << 13
PENALTY = 0.5
STEPS = 40
MEMORY = 8
TOLERANCE = 1e-4
#: The most weights of a model; they are sent to every task.
MOST_WEIGHTS = 4_000_000
#: Numbers that a fold over many sentences holds at once, besides those of its longest sentence.
CELLS = 1 << 20


def token_features(tokens: str, size: int = FEATURES) -> Column:
    """array<array<int>>: hashed features of each token: the word, its last two and three characters, its length and its
    neighbours. An unknown word still has its endings and its place."""

    def slot(kind: str, value: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(kind), value), F.lit(size)).cast("int")

    def of(word: Column, i: Column) -> Column:
        before = F.coalesce(F.get(F.col(tokens), i - 1), F.lit("<"))
        after = F.coalesce(F.get(F.col(tokens), i + 1), F.lit(">"))
        return F.array(
            slot("word", word),
            slot("end2", F.substring(word, -2, 2)),
            slot("end3", F.substring(word, -3, 3)),
            slot("size", F.least(F.length(word), F.lit(12))),
            slot("before", before),
            slot("after", after),
            slot("any", F.lit("")),
        )

    return F.transform(F.col(tokens), of)


def backward() -> Column:
    """array<array<double>>: per token the log of the summed exponent scores of all ways from its tags to the end."""

    def before(found: Column, emit: Column) -> Column:
        after = _add(F.element_at(found, 1), emit)
        return F.concat(F.array(F.transform(F.col("tagger.ahead"), lambda row: _lse(_add(row, after)))), found)

    later = F.reverse(F.slice("emit", F.lit(2), F.greatest(F.size("emit") - 1, F.lit(0))))
    return F.aggregate(later, F.array(F.col("tagger.stop")), before)


def forward() -> Column:
    """array<array<double>>: per token the log of the summed exponent scores of all ways from the start to its tags."""

    def after(found: Column, emit: Column) -> Column:
        last = F.element_at(found, -1)
        return F.concat(found, F.array(F.zip_with(F.col("tagger.step"), emit, lambda row, e: _lse(_add(last, row)) + e)))

    later = F.slice("emit", F.lit(2), F.greatest(F.size("emit") - 1, F.lit(0)))
    return F.aggregate(later, F.array(_first()), after)


def _with_ways(scored: DataFrame) -> DataFrame:
    """Add `__from`, `__to` and `__all` (forward, backward, log-partition). The tagger gets `ahead`: its steps by the tag they leave."""
    tags = F.sequence(F.lit(1), F.size("tagger.tags"))
    ahead = F.transform(tags, lambda i: F.transform(F.col("tagger.step"), lambda row: F.element_at(row, i)))
    ready = scored.withColumn("tagger", F.col("tagger").withField("ahead", ahead))
    ways = F.struct(forward().alias("__from"), backward().alias("__to"), log_partition().alias("__all"))
    # opened from an array of one, so that the folds are not written into the expressions that use them per token
    return ready.select("*", F.inline(F.array(ways)))


def tag_marginals(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., marginals): per token the chance of each tag, in the order of the tagger's tags.

    `scored` has `emit` and `tagger` as `sequence.with_emissions` or
    `with_learned_emissions` makes them; rows may have different taggers.
    Sentences have at least one token; without `emit` there are no marginals.
    The folds go over many sentences at once in Arrow batches.
    """
    tables = [F.col("tagger.start").alias("__start"), F.flatten("tagger.step").alias("__step"), F.col("tagger.stop").alias("__stop")]
    ready = scored.select(*keys, F.col("emit").alias("__emit"), *tables)
    kind = pa.list_(pa.list_(pa.float64()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            emit = batch.column("__emit")
            sizes = pc.fill_null(pc.list_value_length(emit), 0).to_numpy(zero_copy_only=False)
            tokens = emit.flatten()
            width = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
            scores = tokens.flatten().to_numpy(zero_copy_only=False)
            ends, places = np.cumsum(sizes), np.concatenate([[0], np.cumsum(width)])
            chances = np.empty(len(scores))
            for some, start, step, stop in _by_tagger(batch, sizes):
                k = len(start)
                for part in np.split(some, np.flatnonzero(np.diff(np.cumsum(sizes[some]) * k * k // CELLS)) + 1):
                    at = np.repeat(ends[part] - np.cumsum(sizes[part]), sizes[part]) + np.arange(sizes[part].sum())
                    cells = places[at][:, None] + np.arange(k)
                    own = scores[cells]
                    before, after, whole = _ways(own, sizes[part], start, step, stop)
                    chances[cells] = np.exp(before + after - np.repeat(whole, sizes[part])[:, None])
            inner = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(chances))
            outer = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), inner, mask=emit.is_null())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keys], outer.cast(kind)], [*keys, "marginals"])

    schema = StructType([ready.schema[c] for c in keys]).add("marginals", ArrayType(ArrayType(DoubleType())))
    return ready.mapInArrow(run, schema)


def _by_tagger(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(rows, start, step (from x to), stop) of the sentences of a batch that have tokens, for each different tagger."""
    columns = [batch.column(c) for c in ("__start", "__step", "__stop")]
    filled = np.flatnonzero(sizes)
    while len(filled):
        tables = [c[int(filled[0])] for c in columns]
        same = np.logical_and.reduce([_equal_rows(c, int(filled[0]), filled) for c in columns])
        start, step, stop = (t.values.to_numpy(zero_copy_only=False) for t in tables)
        yield filled[same], start, step.reshape(len(start), len(start)).T, stop
        filled = filled[~same]


def _equal_rows(column: pa.ListArray, first: int, rows: np.ndarray) -> np.ndarray:
    """Which of `rows` hold the same numbers as the row `first`."""
    values, size = column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    begin = np.cumsum(size) - size
    same = size[rows] == size[first]
    cells = values[begin[rows[same]][:, None] + np.arange(size[first])]
    same[same] = ((cells == cells[0]) | (cells != cells) & (cells[0] != cells[0])).all(axis=1)
    return same


@dataclass
class TagModel:
    """Learned weights: emit (feature x tag), step (from x to; the last row is START, the last column STOP)."""

    tags: list[str]
    emit: np.ndarray
    step: np.ndarray
    losses: list[float]

    def tagger(self) -> Column:
        """The tables as one constant struct, in the form of `sequence.tagger`; nothing is unseen."""
        k = len(self.tags)
        tables = {
            "tags": self.tags,
            "start": self.step[k, :k].tolist(),
            "step": self.step[:k, :k].T.tolist(),
            "stop": self.step[:k, k].tolist(),
            "unseen": [0.0] * k,
        }
        kind = "struct<tags:array<string>,start:array<double>,step:array<array<double>>,stop:array<double>,unseen:array<double>>"
        return F.from_json(F.lit(json.dumps(tables)), kind)


def with_learned_emissions(sentences: DataFrame, model: TagModel, features: str = "features") -> DataFrame:
    """Add `emit` and `tagger`: the input of `score_paths`, `decode_paths`, `negative_log_likelihood` and `tag_marginals`."""
    weights = F.from_json(F.lit(json.dumps(model.emit.tolist())), "array<array<double>>")
    none = F.array(*[F.lit(0.0)] * len(model.tags))
    emit = F.transform(features, lambda own: F.aggregate(own, none, lambda total, f: _add(total, F.get(weights, f))))
    return sentences.withColumns({"emit": emit, "tagger": model.tagger()})


def count_differences(scored: DataFrame, tags: str = "tags", features: str = "features") -> DataFrame:
    """(kind, slot, sums): expected less observed counts added up over all sentences.

    kind "emit": per feature, an entry per tag. kind "step": per tag that is
    left (START last), an entry per tag that is entered (STOP last). kind
    "loss": one entry, the summed negative log-likelihood.
    """
    size = F.size("tagger.tags")
    rows = _with_ways(scored).withColumn("__given", F.transform(tags, lambda t: F.array_position("tagger.tags", t).cast("int")))
    numbers = F.sequence(F.lit(1), size)

    def hit(place: Column, tag: Column) -> Column:
        return F.when(place == tag, 1.0).otherwise(0.0)

    places = F.arrays_zip(F.col("__from").alias("a"), F.col("__to").alias("b"), F.col("__given").alias("g"), F.col(features).alias("f"))
    off = F.transform(
        places,
        lambda p: F.struct(
            p["f"].alias("f"),
            F.zip_with(F.transform(_add(p["a"], p["b"]), lambda s: F.exp(s - F.col("__all"))), numbers, lambda chance, k: chance - hit(p["g"], k)).alias("r"),
        ),
    )
    emit = F.flatten(F.transform(off, lambda o: F.transform(o["f"], lambda f: F.struct(F.lit("emit").alias("kind"), f.alias("slot"), o["r"].alias("sums")))))

    n = F.size(features)
    inner = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))

    def between(i: Column) -> Column:
        """Per tag entered, the chance of the step from tag i less whether it was taken, over the inside of the sentence."""

        def at(t: Column) -> Column:
            after = _add(F.element_at("emit", t + 1), F.element_at(F.col("__to"), t + 1))
            leave = F.element_at(F.element_at(F.col("__from"), t), i)
            chances = F.zip_with(F.element_at(F.col("tagger.ahead"), i), after, lambda s, a: F.exp(leave + s + a - F.col("__all")))
            taken = F.element_at(F.col("__given"), t) == i
            return F.zip_with(chances, numbers, lambda chance, k: chance - F.when(taken, hit(F.element_at(F.col("__given"), t + 1), k)).otherwise(0.0))

        none = F.transform(numbers, lambda k: F.lit(0.0))
        return F.when(n > 1, F.aggregate(F.transform(inner, at), none, _add)).otherwise(none)

    first, last = F.element_at(off, 1)["r"], F.element_at(off, -1)["r"]
    steps = F.transform(
        numbers, lambda i: F.struct(F.lit("step").alias("kind"), (i - 1).alias("slot"), F.concat(between(i), F.array(F.element_at(last, i))).alias("sums"))
    )
    start = F.array(F.struct(F.lit("step").alias("kind"), size.alias("slot"), F.concat(first, F.array(F.lit(0.0))).alias("sums")))
    loss = F.array(F.struct(F.lit("loss").alias("kind"), F.lit(0).alias("slot"), F.array(F.col("__all") - path_score(tags)).alias("sums")))
    listed = rows.select(F.inline(F.concat(emit, steps, start, loss)))
    opened = listed.select("kind", "slot", F.posexplode("sums").alias("tag", "value"))
    return opened.groupBy("kind", "slot", "tag").agg(F.sum("value").alias("value"))


def _lse_rows(scores: np.ndarray, axis: int) -> np.ndarray:
    top = scores.max(axis=axis, keepdims=True)
    return np.log(np.exp(scores - top).sum(axis=axis)) + top.squeeze(axis)


def _ways(emit: np.ndarray, sizes: np.ndarray, start: np.ndarray, between: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """(before, after, whole) of sentences of `sizes` tokens, at least one each, one step for all of them: per token the logs
    of the summed exponent scores of all ways to and from its tags, and per sentence that of all its taggings."""
    first = np.cumsum(sizes) - sizes
    last = first + sizes - 1
    order = np.argsort(-sizes, kind="stable")
    begin, length = first[order], sizes[order]
    open_ = len(length) - np.searchsorted(length[::-1], np.arange(length[0]), side="right")  # sentences with a token at each place
    before, after = np.empty_like(emit), np.empty_like(emit)
    before[first] = start + emit[first]
    for t in range(1, length[0]):
        at = begin[: open_[t]] + t
        before[at] = _lse_rows(before[at - 1][:, :, None] + between, 1) + emit[at]
    after[last] = stop
    for t in range(length[0] - 1, 0, -1):
        at = begin[: open_[t]] + t
        after[at - 1] = _lse_rows(between + (emit[at] + after[at])[:, None, :], 2)
    return before, after, _lse_rows(before[last] + stop, 1)


class _Sums:
    """Expected less observed counts and the loss, added up over runs of sentences."""

    def __init__(self, model: TagModel):
        self.k = len(model.tags)
        self.weights, self.between = model.emit, model.step[: self.k, : self.k]
        self.start, self.stop = model.step[self.k, : self.k], model.step[: self.k, self.k]
        self.emit, self.step, self.loss = np.zeros_like(model.emit), np.zeros_like(model.step), 0.0

    def add(self, sizes: np.ndarray, given: np.ndarray, counts: np.ndarray, features: np.ndarray) -> None:
        """Sentences of `sizes` tokens, at least one each, with the places of their tags, and `counts` features per token."""
        k, n = self.k, len(given)
        owner = np.repeat(np.arange(n), counts)
        emit = np.stack([np.bincount(owner, self.weights[features, t], n) for t in range(k)], axis=1)
        first = np.cumsum(sizes) - sizes
        last = first + sizes - 1
        before, after, whole = _ways(emit, sizes, self.start, self.between, self.stop)
        all_ = np.repeat(whole, sizes)
        off = np.exp(before + after - all_[:, None])
        off[np.arange(n), given] -= 1.0
        for t in range(k):
            self.emit[:, t] += np.bincount(features, off[owner, t], len(self.emit))
        inner = np.delete(np.arange(n), last)
        for some in np.array_split(inner, 1 + len(inner) * k * k // CELLS):
            chances = before[some][:, :, None] + self.between + (emit[some + 1] + after[some + 1])[:, None, :] - all_[some][:, None, None]
            self.step[:k, :k] += np.exp(chances).sum(axis=0)
        np.subtract.at(self.step, (given[inner], given[inner + 1]), 1.0)
        self.step[k, :k] += off[first].sum(axis=0)
        self.step[:k, k] += off[last].sum(axis=0)
        own = emit[np.arange(n), given].sum() + self.between[given[inner], given[inner + 1]].sum() + self.start[given[first]].sum() + self.stop[given[last]].sum()
        self.loss += float(whole.sum() - own)

    def rows(self) -> pa.RecordBatch:
        """(kind, slot, tag, value) of all sums that are not zero."""
        kinds, slots, tags, values = ["loss"], [np.zeros(1, int)], [np.zeros(1, int)], [np.array([self.loss])]
        for kind, table in (("emit", self.emit), ("step", self.step)):
            slot, tag = np.nonzero(table)
            kinds += [kind] * len(slot)
            slots, tags, values = [*slots, slot], [*tags, tag], [*values, table[slot, tag]]
        columns = [pa.array(kinds), pa.array(np.concatenate(slots), pa.int32()), pa.array(np.concatenate(tags), pa.int32()), pa.array(np.concatenate(values))]
        return pa.RecordBatch.from_arrays(columns, ["kind", "slot", "tag", "value"])


def summed_differences(sentences: DataFrame, model: TagModel, tags: str = "tags", features: str = "features") -> DataFrame:
    """(kind, slot, tag, value) as `count_differences`, without cells that are zero, from sentences without scores.

    Each task folds runs of about CELLS numbers, one step for all their
    sentences, and hands on one table of sums. Sentences without tokens add
    nothing.
    """
    most = max(1, CELLS // len(model.tags) ** 2)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(model)
        for batch in batches:
            listed, nested = batch.column("tags"), batch.column("features")
            sizes = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
            given = pc.index_in(listed.flatten(), pa.array(model.tags)).to_numpy(zero_copy_only=False)
            tokens = nested.flatten()
            counts, slots = pc.list_value_length(tokens).to_numpy(zero_copy_only=False), tokens.flatten().to_numpy(zero_copy_only=False)
            ends, slot_ends = np.cumsum(sizes), np.concatenate([[0], np.cumsum(counts)])
            cuts = [0, *(np.flatnonzero(np.diff((ends - 1) // most)) + 1), len(sizes)]
            for a, b in zip(cuts, cuts[1:]):
                low, high = (ends[a - 1] if a else 0), (ends[b - 1] if b else 0)
                if high > low:
                    sums.add(sizes[a:b], given[low:high], counts[low:high], slots[slot_ends[low] : slot_ends[high]])
        yield sums.rows()

    ready = sentences.select(F.col(tags).alias("tags"), F.col(features).alias("features")).filter(F.size("features") > 0)
    found = ready.mapInArrow(run, "kind string, slot int, tag int, value double")
    return found.groupBy("kind", "slot", "tag").agg(F.sum("value").alias("value"))


def _objective(sentences: DataFrame, model: TagModel, tags: str, penalty: float) -> tuple[float, np.ndarray]:
    """Penalised negative log-likelihood and its slope at the weights of `model`."""
    emit, step, loss = np.zeros_like(model.emit), np.zeros_like(model.step), 0.0
    for kind, slot, tag, value in summed_differences(sentences, model, tags).collect():
        if kind == "loss":
            loss = value
        else:
            (emit if kind == "emit" else step)[slot, tag] = value
    weights = np.concatenate([model.emit.ravel(), model.step.ravel()])
    slope = np.concatenate([emit.ravel(), step.ravel()])
    return float(loss + penalty * (weights**2).sum() / 2), slope + penalty * weights


def _direction(slope: np.ndarray, past: deque) -> np.ndarray:
    """The L-BFGS step for a slope, from past (moves, changes of the slope)."""
    q, kept = slope.copy(), []
    for s, y in reversed(past):
        a = (s @ q) / (s @ y)
        q -= a * y
        kept.append(a)
    if past:
        s, y = past[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(past, reversed(kept)):
        q += (a - (y @ q) / (s @ y)) * s
    return -q


def fit_tags(
    sentences: DataFrame, tokens: str = "tokens", tags: str = "tags", size: int = FEATURES, penalty: float = PENALTY, steps: int = STEPS
) -> TagModel:
    """Weights that minimise the negative log-likelihood of the given tags plus `penalty` / 2 times the squared weights.

    The tag inventory is that of `sentences`. Sentences without tokens are left
    out; one whose tags are fewer than its tokens, or null, is an error of the
    caller. Stops after `steps` accepted steps or when a step gains less than
    TOLERANCE of the loss. Without sentences there are no tags and no weights.
    """
    rows = sentences.filter(F.size(tokens) > 0).select(F.col(tags).alias("tags"), token_features(tokens, size).alias("features"))
    rows = cut_lineage(rows)
    inventory = [r[0] for r in rows.select(F.explode("tags")).distinct().orderBy("col").collect()]
    k = len(inventory)
    if size * k > MOST_WEIGHTS:
        raise ValueError(f"{size * k} weights; a model may have {MOST_WEIGHTS}")
    model = TagModel(inventory, np.zeros((size, k)), np.zeros((k + 1, k + 1)), [])
    if not k:
        return model

    def at(weights: np.ndarray) -> TagModel:
        return TagModel(inventory, weights[: size * k].reshape(size, k), weights[size * k :].reshape(k + 1, k + 1), model.losses)

    weights = np.zeros(size * k + (k + 1) ** 2)
    loss, slope = _objective(rows, model, "tags", penalty)
    model.losses.append(loss)
    past: deque = deque(maxlen=MEMORY)
    for _ in range(steps):
        move = _direction(slope, past)
        if not past:
            move /= max(1.0, float(np.abs(move).sum()) / 10)
        length, gain = 1.0, float(slope @ move)
        while True:
            trial = weights + length * move
            new_loss, new_slope = _objective(rows, at(trial), "tags", penalty)
            if new_loss <= loss + 1e-4 * length * gain or length < 1e-4:
                break
            length /= 2
        s, y = trial - weights, new_slope - slope
        if s @ y > 1e-12 * (y @ y):
            past.append((s, y))
        done = loss - new_loss < TOLERANCE * abs(loss)
        weights, loss, slope = trial, new_loss, new_slope
        model.losses.append(loss)
        if done:
            break
    return at(weights)
