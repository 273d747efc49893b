"""Gradient boosted trees of one objective: softmax over all classes, logistic, or squared error.

A round fits one regression tree per class to the gradients of the shared loss. A level of all trees
of a round is one job: tasks add up gradients and curvatures by class, node, feature and bin, sums
meet in one aggregate, and Spark picks each node's best split, so that a row per node reaches the
driver. Leaves hold the Newton step. Features are cut into bins once; rows carry bins, the gradient's
ingredients and their margins, which are written anew after every few rounds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiform.cluster import checkpointed
from lexiform.functions.vectors import as_array

# Rounds after which margins are written.
REFRESH = 10

# Cells of a histogram that a task holds, two numbers each.
CELLS = 4_000_000

OBJECTIVES = ("softmax", "logistic", "squared")


@dataclass
class Settings:
    """How trees are grown."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    max_bins: int = 32
    binning: str = "quantile"  # or "width": bins of equal width
    subsample: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes from the root: the feature and edge of a split, its children, or a leaf's value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    edge: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, edge: float, values: tuple[float, float]) -> int:
        """Put two leaves below a node; returns the number of the left one."""
        self.feature[node], self.edge[node], self.left[node] = feature, edge, len(self.value)
        for value in values:
            self.feature.append(-1)
            self.edge.append(0.0)
            self.left.append(0)
            self.value.append(value)
        return self.left[node]

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: values below the edge go left."""
        feature, edge, left = map(np.asarray, (self.feature, self.edge, self.left))
        node = np.zeros(len(rows), np.int64)
        while True:
            inner = np.flatnonzero(feature[node] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            right = ~(rows[inner, feature[at]] < edge[at])
            node[inner] = left[at] + right


@dataclass
class Boosted:
    """A fitted model: rounds of one tree per output, on top of the base margin."""

    objective: str
    base: float
    rounds: list[list[Tree]]
    width: int

    def margins(self, rows: np.ndarray, outputs: int) -> np.ndarray:
        out = np.full((len(rows), outputs), self.base)
        for trees in self.rounds:
            for c, tree in enumerate(trees):
                out[:, c] += np.asarray(tree.value)[tree.leaves(rows)]
        return out

    def to_json(self) -> str:
        trees = [[[t.feature, t.edge, t.left, t.value] for t in r] for r in self.rounds]
        return json.dumps([self.objective, self.base, trees, self.width])

    @classmethod
    def from_json(cls, text: str) -> Boosted:
        objective, base, trees, width = json.loads(text)
        return cls(objective, base, [[Tree(*t) for t in r] for r in trees], width)

    @property
    def n_nodes(self) -> int:
        return sum(len(t.value) for r in self.rounds for t in r)


def chances(margins: np.ndarray, objective: str) -> np.ndarray:
    """Probabilities of the classes."""
    if objective == "logistic":
        p = 1 / (1 + np.exp(-margins[:, 0]))
        return np.column_stack([1 - p, p])
    powers = np.exp(margins - margins.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def gradients(margins: np.ndarray, label: np.ndarray, weight: np.ndarray, objective: str):
    """First and second derivatives of the weighted loss by each margin."""
    if objective == "squared":
        return weight[:, None] * (margins - label[:, None]), np.repeat(weight[:, None], 1, axis=1)
    p = chances(margins, objective)
    if objective == "logistic":
        return weight[:, None] * (p[:, 1:] - label[:, None]), weight[:, None] * p[:, 1:] * p[:, :1]
    target = label.astype(np.int64)[:, None] == np.arange(p.shape[1])
    return weight[:, None] * (p - target), weight[:, None] * np.maximum(2 * p * (1 - p), 1e-16)


def bin_edges(rows: DataFrame, features: str, width: int, settings: Settings) -> list[np.ndarray]:
    """Per feature the lower edges of its bins but the first."""
    bins = settings.max_bins
    if settings.binning == "width":
        array = F.col(features)
        spans = rows.agg(
            *[F.min(F.get(array, i)) for i in range(width)], *[F.max(F.get(array, i)) for i in range(width)]
        ).first()
        low, high = np.array(spans[:width], float), np.array(spans[width:], float)
        return [np.unique(a + (b - a) * np.arange(1, bins) / bins) for a, b in zip(low, high)]
    parts = [f"_f{i}" for i in range(width)]
    wide = rows.select(*[F.get(features, i).alias(n) for i, n in enumerate(parts)])
    found = wide.approxQuantile(parts, [i / bins for i in range(1, bins)], 0.1 / bins)
    return [np.unique(e) for e in found]


def fit(
    df: DataFrame,
    outputs: int,
    objective: str,
    settings: Settings,
    features: str = "features",
    label: str = "label",
    weight: str = "",
) -> Boosted:
    """Fit trees; ``outputs`` is the number of classes for softmax and 1 else.

    Rows without a label are left out. Ties between splits go to the first feature and bin. With
    ``subsample`` below 1 a round sees the rows whose hash falls to it.
    """
    if objective not in OBJECTIVES or settings.binning not in ("quantile", "width"):
        raise ValueError(f"unknown objective {objective!r} or binning {settings.binning!r}")
    rows = df.select(
        as_array(df, features).alias("x"),
        F.col(label).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
    ).filter("y IS NOT NULL")
    rows = checkpointed(rows)
    sums = rows.agg(F.max(F.size("x")), F.sum(F.col("y") * F.col("w")) / F.sum("w")).first()
    width = sums[0] or 0
    base = float(sums[1] or 0.0) if objective == "squared" else 0.0
    edges = bin_edges(rows, "x", width, settings)
    state = checkpointed(rows.mapInArrow(_binned(edges, outputs, base), STATE))
    model, waiting = Boosted(objective, base, [], width), []
    for number in range(settings.n_estimators):
        trees = _grown(state, waiting, edges, outputs, objective, settings, number)
        model.rounds.append([_with_edges(t, edges) for t in trees])
        waiting.append(trees)
        if all(len(t.value) == 1 for t in trees):
            break
        if len(waiting) == REFRESH:
            state = checkpointed(state.mapInArrow(_advanced(waiting, outputs), STATE))
            waiting = []
    return model


# A row's bins, label, weight and margins.
STATE = "bins binary, y double, w double, margins binary, draw double"


def _binned(edges: list[np.ndarray], outputs: int, base: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = np.full(outputs, base).tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("x").to_pylist(), float)
            bins = np.column_stack(
                [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(edges)]
            ).astype("<u2")
            data = [row.tobytes() for row in bins]
            draw = np.array([hash_of(d) for d in data])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(data, pa.binary()), batch.column("y"), batch.column("w"),
                    pa.array([start] * len(data), pa.binary()), pa.array(draw),
                ],
                names=["bins", "y", "w", "margins", "draw"],
            )

    return run


def hash_of(data: bytes) -> float:
    """A number in [0, 1) that depends on the bins alone."""
    from zlib import crc32

    return crc32(data) / 2**32


def _arrays(batch: pa.RecordBatch, outputs: int) -> tuple[np.ndarray, np.ndarray]:
    n = batch.num_rows
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), "<u2").reshape(n, -1)
    margins = np.frombuffer(b"".join(batch.column("margins").to_pylist()), "<f8").reshape(n, outputs)
    return bins, margins.copy()


def _moved(bins: np.ndarray, margins: np.ndarray, waiting: list[list[Tree]]) -> np.ndarray:
    for trees in waiting:
        for c, tree in enumerate(trees):
            margins[:, c] += np.asarray(tree.value)[tree.leaves(bins)]
    return margins


def _advanced(waiting: list[list[Tree]], outputs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                margins = _moved(*_arrays(batch, outputs), waiting)
                at = batch.schema.get_field_index("margins")
                yield batch.set_column(at, "margins", pa.array([m.tobytes() for m in margins], pa.binary()))

    return run


HISTOGRAM = "class int, node int, feature int, bin int, g double, h double"


def _grown(state, waiting, edges, outputs: int, objective: str, settings: Settings, number: int) -> list[Tree]:
    """The trees of one round, in terms of bins."""
    trees = [Tree() for _ in range(outputs)]
    lam = F.lit(settings.reg_lambda)
    order = Window.partitionBy("class", "node", "feature").orderBy("bin")
    whole = Window.partitionBy("class", "node", "feature")

    def score(g, h):
        return g * g / (h + lam)

    open_nodes = [{0} for _ in trees]
    for _ in range(settings.max_depth):
        run = _histogram(waiting, trees, open_nodes, len(edges), edges, outputs, objective, settings, number)
        sums = state.mapInArrow(run, HISTOGRAM).groupBy("class", "node", "feature", "bin").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h")
        )
        sides = sums.select(
            "class", "node", "feature", "bin",
            F.sum("g").over(order).alias("gl"), F.sum("h").over(order).alias("hl"),
            F.sum("g").over(whole).alias("ga"), F.sum("h").over(whole).alias("ha"),
            F.lead("bin").over(order).alias("next"),
        )
        gr, hr = F.col("ga") - F.col("gl"), F.col("ha") - F.col("hl")
        gain = 0.5 * (score(F.col("gl"), F.col("hl")) + score(gr, hr) - score(F.col("ga"), F.col("ha")))
        allowed = (F.col("hl") >= settings.min_child_weight) & (hr >= settings.min_child_weight)
        chosen = (
            sides.withColumns({"gain": F.round(gain - settings.gamma, 9), "gr": gr, "hr": hr})
            .filter(F.col("next").isNotNull() & allowed & (F.col("gain") > 0))
            .groupBy("class", "node")
            .agg(
                F.max_by(
                    F.struct("feature", "bin", "gl", "hl", "gr", "hr"),
                    F.struct("gain", -F.col("feature"), -F.col("bin")),
                ).alias("best")
            )
            .collect()  # a row per open node
        )
        open_nodes = [set() for _ in trees]
        for row in sorted(chosen, key=lambda r: (r["class"], r["node"])):
            best, tree = row["best"], trees[row["class"]]
            rate = settings.learning_rate
            values = tuple(
                -rate * g / (h + settings.reg_lambda)
                for g, h in ((best["gl"], best["hl"]), (best["gr"], best["hr"]))
            )
            left = tree.split(row["node"], best["feature"], best["bin"] + 1, values)
            open_nodes[row["class"]] |= {left, left + 1}
        if not chosen:
            break
    return trees


def _histogram(waiting, trees, open_nodes, width, edges, outputs, objective, settings, number):
    bins_most = max((len(e) for e in edges), default=0) + 1
    nodes = [np.full(len(t.value), -1, np.int64) for t in trees]
    for at, held in zip(nodes, open_nodes):
        for i, node in enumerate(sorted(held)):
            at[node] = i
    names = [np.array(sorted(held), np.int64) for held in open_nodes]
    # Features that are added up at a time.
    step = max(1, CELLS // max(1, bins_most * max(len(n) for n in names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[tuple[int, int], np.ndarray] = {}
        few = sum(len(n) for n in names) * width * bins_most <= CELLS

        def rows(c: int, first: int, cells: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero((cells != 0).any(axis=0))
            rest, bin_ = np.divmod(at, bins_most)
            node, feature = np.divmod(rest, cells.shape[1] // bins_most // len(names[c]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(at), c, np.int32)), pa.array(names[c][node].astype(np.int32)),
                    pa.array((feature + first).astype(np.int32)), pa.array(bin_.astype(np.int32)),
                    pa.array(cells[0][at]), pa.array(cells[1][at]),
                ],
                names=["class", "node", "feature", "bin", "g", "h"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            bins, margins = _arrays(batch, outputs)
            margins = _moved(bins, margins, waiting)
            y, w = (batch.column(c).to_numpy() for c in ("y", "w"))
            if settings.subsample < 1:
                turn = (batch.column("draw").to_numpy() + (number + settings.seed) * 0.6180339887498949) % 1
                w = np.where(turn < settings.subsample, w, 0.0)
            g, h = gradients(margins, y, w, objective)
            for c, tree in enumerate(trees):
                if not len(names[c]):
                    continue
                node = nodes[c][tree.leaves(bins)]
                some = np.flatnonzero((node >= 0) & (w > 0))
                for first in range(0, width, step):
                    part = bins[some, first : first + step].astype(np.int64)
                    n = part.shape[1]
                    key = ((node[some, None] * n + np.arange(n)) * bins_most + part).ravel()
                    size = len(names[c]) * n * bins_most
                    cells = np.stack(
                        [np.bincount(key, np.repeat(v[some, c], n), size) for v in (g, h)]
                    ).astype(float)  # without rows they are integers
                    if few:
                        held = whole.get((c, first))
                        whole[c, first] = cells if held is None else held + cells
                    else:
                        yield rows(c, first, cells)
        for (c, first), cells in whole.items():
            yield rows(c, first, cells)

    return run


def _with_edges(tree: Tree, edges: list[np.ndarray]) -> Tree:
    """A tree over bins as one over values."""
    edge = [float(edges[f][int(e) - 1]) if f >= 0 else 0.0 for f, e in zip(tree.feature, tree.edge)]
    return Tree(list(tree.feature), edge, list(tree.left), list(tree.value))
