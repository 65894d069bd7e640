"""Leaf-wise gradient boosting on feature histograms, stopped while it fits.

Columns are cut into bins once. In a round every training row adds its slope
and curvature of the logistic loss to one cell per feature of its leaf. A task
adds up its Arrow batches in one table of cells, and the tables are summed by
(leaf, feature, bin); leaves x features x bins sums reach the driver, whatever
the number of rows. The leaf with the largest gain is
split first, up to a number of leaves. One pass serves all leaves that may be
split next: it reads the smaller child of each, the sibling is the difference
from the parent. Margins are stored every few rounds, so a round never starts
from the first tree. Validation rows ride along in the first pass of a round;
when their loss has not fallen for `patience` rounds the fit ends.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from tabloom.operators.attribution import NODES
from tabloom.session import cut_lineage

STORED_ROUNDS = 10
#: Rows that a task reads in each pass.
TASK_ROWS = 50_000


@dataclass(frozen=True)
class Boosting:
    """Settings in the usual names of such libraries."""

    rounds: int = 200
    learning_rate: float = 0.1
    num_leaves: int = 31
    max_depth: int = 16
    lambda_l1: float = 0.0
    lambda_l2: float = 0.0
    min_rows: int = 20
    min_curvature: float = 1e-3
    feature_fraction: float = 1.0
    bagging_fraction: float = 1.0
    bagging_freq: int = 1
    bins: int = 255
    patience: int | None = None
    seed: int = 42


@dataclass
class Node:
    """A node of a growing tree; `cells` has (slope, curvature, rows) per feature and bin."""

    number: int
    depth: int
    cells: np.ndarray
    split: tuple[int, int] | None = None  # feature, last bin of the left side
    gain: float = 0.0
    left: Node | None = None
    right: Node | None = None
    chosen: bool = False
    value: float = 0.0

    @property
    def sums(self) -> np.ndarray:
        return self.cells[0].sum(axis=0)


@dataclass
class LeafwiseModel:
    """Fitted trees, the bin edges of each column, the margin before the first tree and the validation loss after each number of trees."""

    columns: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Node] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)
    best: int = 0

    def margin(self, trees: int | None = None) -> Column:
        """The margin as an expression on the array column `bins`."""
        total = F.lit(self.base)
        for root in self.trees[: self.best if trees is None else trees]:
            total = total + _value(root)
        return total

    def scores(self, df: DataFrame, key: Sequence[str]) -> DataFrame:
        """(key, score): the chance of class 1 by the best number of trees."""
        raised = _raised(binned(df, self.columns, self.edges, key), self.trees[: self.best], F.lit(self.base))
        return raised.select(*key, (1 / (1 + F.exp(-F.col("margin")))).alias("score"))

    def nodes(self, df: DataFrame) -> DataFrame:
        """The best trees as rows for `attribution.tree_paths`, on the values of the columns themselves; cover counts rows."""
        rows = []
        for tree, root in enumerate(self.trees[: self.best]):
            open_ = [root]
            while open_:
                n = open_.pop()
                cover = float(n.sums[2])
                if n.chosen:
                    k, b = n.split
                    threshold = self.edges[k][b] if b < len(self.edges[k]) else math.inf
                    rows.append((tree, n.number, n.left.number, n.right.number, k, threshold, None, cover, 0.0))
                    open_ += [n.left, n.right]
                else:
                    rows.append((tree, n.number, -1, -1, -1, None, None, cover, n.value))
        return df.sparkSession.createDataFrame(rows, NODES)


def bin_edges(df: DataFrame, columns: Sequence[str], bins: int) -> list[list[float]]:
    """Per column at most `bins` - 1 inner edges: quantiles, the largest value left out; one pass, few numbers to the driver."""
    shares = [k / bins for k in range(1, bins)]
    quantiles = df.approxQuantile(list(columns), shares, 1 / (4 * bins))
    tops = df.agg(*[F.max(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return [sorted({v for v in found if tops[c] is not None and v < tops[c]}) for c, found in zip(columns, quantiles)]


def binned(df: DataFrame, columns: Sequence[str], edges: list[list[float]], kept: Sequence[str]) -> DataFrame:
    """(kept, bins): the number of edges below each value; an unknown value has a bin of its own after the last."""
    ready = df.select(*kept, *[F.col(c).cast("double").alias(f"__x{k}") for k, c in enumerate(columns)])
    borders = [np.array(own, float) for own in edges]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.empty((batch.num_rows, len(borders)), np.int32)
            for k, own in enumerate(borders):
                value = batch.column(f"__x{k}").to_numpy(zero_copy_only=False).astype(float)
                bins[:, k] = np.where(np.isnan(value), len(own) + 1, np.searchsorted(own, value, "left"))
            listed = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * len(borders), pa.int32()), pa.array(bins.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], listed], [*kept, "bins"])

    return ready.mapInArrow(run, StructType([ready.schema[c] for c in kept]).add("bins", ArrayType(IntegerType())))


def _bagged(key: Sequence[str], draw: int, share: float, seed: int) -> Column:
    if share >= 1.0:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(draw), *key), F.lit(1 << 30)) < int(share * (1 << 30))


def _walk(root: Node, bins: np.ndarray, tried: bool) -> Iterator[tuple[Node, np.ndarray]]:
    """The nodes that rows fall into, with the rows of each; of splits the chosen ones and, if `tried`, those tried out."""
    open_ = [(root, np.arange(len(bins)))]
    while open_:
        node, rows = open_.pop()
        if node.left is None or not (tried or node.chosen):
            yield node, rows
            continue
        k, b = node.split
        goes = bins[rows, k] <= b
        open_ += [(node.left, rows[goes]), (node.right, rows[~goes])]


def _value(root: Node) -> Column:
    if not root.chosen:
        return F.lit(root.value)
    k, b = root.split
    return F.when(F.col("bins")[k] <= b, _value(root.left)).otherwise(_value(root.right))


def _raised(df: DataFrame, trees: Sequence[Node], start: Column) -> DataFrame:
    """The rows of `df`, which has `bins`, with `margin`: `start` and the values of the trees on top."""
    trees, ready = [_without_cells(t) for t in trees], df.withColumn("margin", start)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = batch.column("margin").to_numpy(zero_copy_only=False).copy()
            if len(margin):
                bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(len(margin), -1)
                _raise(margin, trees, bins)
            at = batch.schema.get_field_index("margin")
            yield batch.set_column(at, "margin", pa.array(margin))

    return ready.mapInArrow(run, ready.schema)


def _raise(margin: np.ndarray, trees: Sequence[Node], bins: np.ndarray) -> None:
    for tree in trees:
        for node, rows in _walk(tree, bins, False):
            margin[rows] += node.value


def _shrunk(slope: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(slope) * np.maximum(np.abs(slope) - l1, 0.0)


def best_split(cells: np.ndarray, allowed: Sequence[int], s: Boosting) -> tuple[float, tuple[int, int] | None]:
    """The gain and (feature, last left bin) of the best split; the first feature and bin win ties."""
    total = cells[allowed[0]].sum(axis=0)
    found, split = 0.0, None

    def score(part: np.ndarray) -> np.ndarray:
        return _shrunk(part[..., 0], s.lambda_l1) ** 2 / np.maximum(part[..., 1] + s.lambda_l2, 1e-300)

    for k in allowed:
        left = np.cumsum(cells[k], axis=0)[:-1]
        right = total - left
        fits = (left[:, 2] >= s.min_rows) & (right[:, 2] >= s.min_rows) & (left[:, 1] >= s.min_curvature) & (right[:, 1] >= s.min_curvature)
        gain = np.where(fits, score(left) + score(right) - score(total), 0.0)
        if len(gain) and gain.max() > found + 1e-12 * abs(found):
            found, split = float(gain.max()), (k, int(gain.argmax()))
    return found, split


@dataclass
class Pass:
    """One look at all rows: the cells of the `wanted` nodes of the tree `root` under the trees `fresh` since the margins were stored.

    `tested` also asks for the loss of the rows left out.
    """

    root: Node
    wanted: list[int]
    fresh: list[Node]
    shape: tuple[int, int]
    tested: bool = False

    def sums(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(node, feature, bin, g, h, n) over all rows of a task; node -1: summed loss and weight of the rows left out."""
        features, size = self.shape
        cells = {n: np.zeros((features * size, 3)) for n in self.wanted}
        loss, seen = np.zeros(2), False
        offsets = np.arange(features) * size
        for batch in batches:
            bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(-1, features)
            y, w, margin = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("__y", "__w", "margin"))
            taken, valid = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__taken", "__valid"))
            _raise(margin, self.fresh, bins)
            if self.tested and valid.any():
                m = margin[valid]
                loss += (w[valid] * (np.maximum(m, 0.0) + np.log1p(np.exp(-np.abs(m))) - y[valid] * m)).sum(), w[valid].sum()
                seen = True
            bins, y, w, margin = bins[taken], y[taken], w[taken], margin[taken]
            p = 1 / (1 + np.exp(-margin))
            g, h = w * (p - y), w * p * (1 - p)
            for node, rows in _walk(self.root, bins, True):
                if node.number in cells and len(rows):
                    at = (bins[rows] + offsets).ravel()
                    for k, values in enumerate((g[rows], h[rows], np.ones(len(rows)))):
                        cells[node.number][:, k] += np.bincount(at, np.repeat(values, features), features * size)
        out = [(n, place // size, place % size, *found[place].T) for n, found in cells.items() if len(place := np.flatnonzero(found[:, 2]))]
        if seen:
            out.append((-1, *np.zeros((2, 1), int), loss[:1], loss[1:], np.ones(1)))
        if out:
            nodes = np.concatenate([np.full(len(o[1]), o[0], np.int32) for o in out])
            columns = [np.concatenate([o[k] for o in out]).astype(kind) for k, kind in zip(range(1, 6), ("i4", "i4", "f8", "f8", "i8"))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (nodes, *columns)], ["node", "feature", "bin", "g", "h", "n"])


def _without_cells(root: Node) -> Node:
    """A copy of a tree as the tasks need it."""
    parts = {"left": root.left and _without_cells(root.left), "right": root.right and _without_cells(root.right)}
    return replace(root, cells=np.empty((0, 0, 3)), **parts)


def _histograms(stored: DataFrame, look: Pass) -> tuple[dict[int, np.ndarray], float | None]:
    """Per wanted node its cells over the rows taken, and the mean loss of the rows left out.

    Each task adds up its rows and hands on one table of sums, so what is
    shuffled does not depend on the number of rows in a task; the trees travel
    with the function, so that every pass has the same plan.
    """
    look = replace(look, root=_without_cells(look.root), fresh=[_without_cells(t) for t in look.fresh])
    parts = stored.select("bins", "__y", "__w", "margin", "__taken", "__valid").mapInArrow(look.sums, "node int, feature int, bin int, g double, h double, n bigint")
    sums = parts.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    found, loss = {n: np.zeros((*look.shape, 3)) for n in look.wanted}, None
    for node, feature, place, *values in sums.collect():
        if node < 0:
            loss = values[0] / values[1] if values[1] else None
        else:
            found[node][feature, place] = values
    return found, loss


def grow(rows: DataFrame, root: Node, allowed: Sequence[int], s: Boosting, fresh: Sequence[Node] = ()) -> None:
    """Split best-first up to `num_leaves`; children are looked at for all leaves that may still be split, in one pass."""
    shape = root.cells.shape[:2]
    number = 0

    def judge(n: Node) -> None:
        n.gain, n.split = best_split(n.cells, allowed, s) if n.depth < s.max_depth else (0.0, None)

    judge(root)
    leaves = [root]
    while len(leaves) < s.num_leaves:
        ready = sorted((n for n in leaves if n.split is not None), key=lambda n: (-n.gain, n.number))
        if not ready:
            break
        top = ready[0]
        if top.left is None:
            small = {}
            for n in [m for m in ready if m.left is None][: s.num_leaves - len(leaves)]:
                k, b = n.split
                n.left, n.right = Node(number + 1, n.depth + 1, n.cells), Node(number + 2, n.depth + 1, n.cells)
                number += 2
                less = n.cells[k, : b + 1, 2].sum() * 2 <= n.cells[k, :, 2].sum()
                small[(n.left if less else n.right).number] = n, less
            found, _ = _histograms(rows, Pass(root, list(small), list(fresh), shape))
            for at, (n, less) in small.items():
                part, rest = found[at], n.cells - found[at]
                n.left.cells, n.right.cells = (part, rest) if less else (rest, part)
                judge(n.left)
                judge(n.right)
        top.chosen = True
        leaves = [n for n in leaves if n is not top] + [top.left, top.right]
    for n in leaves:
        slope, curvature, _ = n.sums
        n.value = float(-s.learning_rate * _shrunk(slope, s.lambda_l1) / max(curvature + s.lambda_l2, 1e-300))


def fit_leafwise(
    df: DataFrame, columns: Sequence[str], key: Sequence[str], settings: Boosting = Boosting(), label: str = "label", weight: str = "weight", valid: Column | None = None
) -> LeafwiseModel:
    """Trees on the numeric `columns`; rows where `valid` is true are left out and used to stop.

    An unknown value goes to the right side of every split. Rows with an unknown
    label or weight are left out. Rows are bagged by a hash of `key`, anew every
    `bagging_freq` rounds. Without rows, or with rows of one label, there are no
    trees and the margin stays at the log-odds, cut at +-15.
    """
    s = settings
    known = df.filter(F.col(label).isNotNull() & F.col(weight).isNotNull()).withColumn("__valid", F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(False))
    edges = bin_edges(known, columns, s.bins)
    shape = (len(columns), max(len(e) for e in edges) + 2)
    base = binned(known.withColumns({"__y": F.col(label).cast("double"), "__w": F.col(weight).cast("double")}), columns, edges, [*key, "__y", "__w", "__valid"])
    base = cut_lineage(base)
    facts = base.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.when(~F.col("__valid"), v)).alias(c) for c, v in (("w", F.col("__w")), ("p", F.col("__w") * F.col("__y")))]).first()
    share = (facts["p"] or 0.0) / facts["w"] if facts["w"] else 0.5
    start = max(-15.0, min(15.0, math.log(share / (1 - share)))) if 0 < share < 1 else math.copysign(15.0, share - 0.5) if share != 0.5 else 0.0
    model = LeafwiseModel(list(columns), edges, start)
    if not 0 < share < 1 or not facts["w"]:
        return model
    # every task hands on a table of sums, so their number follows the rows
    stored, fresh = cut_lineage(base.withColumn("margin", F.lit(start)).repartition(-(-facts["n"] // TASK_ROWS))), []
    source = random.Random(s.seed)
    for number in range(s.rounds + 1):
        if len(fresh) >= STORED_ROUNDS:
            stored = cut_lineage(_raised(stored, fresh, F.col("margin")))
            fresh = []
        rows = stored.withColumn("__taken", ~F.col("__valid") & _bagged(key, number // s.bagging_freq, s.bagging_fraction, s.seed))
        cells, tested_loss = _histograms(rows, Pass(Node(0, 0, np.empty((0, 0, 3))), [0], fresh, shape, valid is not None))
        if tested_loss is not None:
            model.losses.append(tested_loss)
            if tested_loss < model.losses[model.best]:
                model.best = number
            if s.patience is not None and number - model.best >= s.patience:
                break
        if number == s.rounds or not cells[0][:, :, 2].any():
            break
        root = Node(0, 0, cells[0])
        size = max(1, round(s.feature_fraction * len(columns)))
        grow(rows, root, sorted(source.sample(range(len(columns)), size)), s, fresh)
        model.trees.append(root)
        fresh.append(root)
    if not model.losses:
        model.best = len(model.trees)
    return model
