"""Exact k nearest neighbours and their vote.

Few queries go to the training rows as a broadcast. Many are joined by pivots: every training row
belongs to the cell of its nearest pivot. A first pass takes each query to the cells of its nearest
pivots until these hold k rows, which gives it a distance that its neighbours cannot exceed. A second
pass takes it to those other cells that can hold a nearer row by two bounds of the triangle
inequality: the cell's rows lie between its inner and outer radius, and nearer to its pivot than to
the query's own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from lexiform.cluster import checkpointed, settled
from lexiform.functions.vectors import as_array

# Queries of at most this many numbers are broadcast.
BROADCAST_NUMBERS = 8_000_000

# Training rows per cell, until the pivots reach BROADCAST_NUMBERS, and rows per block of a cell.
CELL_ROWS = 2_000
BLOCK_ROWS = 20_000

# Numbers held at once while distances are computed.
WORKING_NUMBERS = 1_000_000

METRICS = {"minkowski": None, "euclidean": 2, "manhattan": 1}


def matrix(vectors: Sequence) -> np.ndarray:
    """A column of equally long arrays as one matrix."""
    return np.array([np.asarray(v, dtype=float) for v in vectors])


def distances(left: np.ndarray, right: np.ndarray, p: float) -> np.ndarray:
    """Minkowski distance of the rows of one matrix to the rows of another, in step."""
    out = np.empty(len(left))
    step = max(1, WORKING_NUMBERS // max(1, left.shape[1]))
    for start in range(0, len(left), step):
        gap = np.abs(left[start : start + step] - right[start : start + step])
        total = gap.sum(axis=1) if p == 1 else (gap**p).sum(axis=1)
        out[start : start + step] = total if p == 1 else total ** (1.0 / p)
    return out


def near_pairs(points: np.ndarray, rows: np.ndarray, k: int, p: float):
    """Pairs (point, row) that are sure to hold each point's k nearest rows.

    Euclidean distances are first estimated by a matrix product; only pairs
    that could be among the k nearest, given its rounding error, remain.
    """
    if p != 2 or len(rows) <= k:
        return np.repeat(np.arange(len(points)), len(rows)), np.tile(np.arange(len(rows)), len(points))
    lengths, spans = (points**2).sum(axis=1)[:, None], (rows**2).sum(axis=1)[None, :]
    rough = lengths + spans - 2.0 * (points @ rows.T)
    slack = 8 * (points.shape[1] + 8) * np.finfo(float).eps * (lengths + spans.max())
    kth = np.partition(rough, k - 1, axis=1)[:, k - 1 : k]
    limit = (np.sqrt(np.maximum(kth, 0.0) + slack) + 2e-9) ** 2 + slack
    return np.nonzero(rough <= limit)


def nearest(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, labels: np.ndarray,
    rows: np.ndarray, k: int, p: float,
) -> pd.DataFrame:
    """The k nearest rows of each query, ties by id."""
    order_ids = np.asarray(ids.tolist()) if ids.dtype == object else ids
    parts = []
    step = max(1, WORKING_NUMBERS // (len(rows) * (1 if p == 2 else rows.shape[1])))
    for start in range(0, len(queries), step):
        points = queries[start : start + step]
        asked, found = near_pairs(points, rows, k, p)
        gap = np.empty(len(asked))
        size = max(1, WORKING_NUMBERS // rows.shape[1])
        for at in range(0, len(asked), size):
            some = slice(at, at + size)
            gap[some] = distances(points[asked[some]], rows[found[some]], p)
        gap = np.round(gap, 9)
        order = np.lexsort((order_ids[found], gap, asked))
        asked, found, gap = asked[order], found[order], gap[order]
        place = np.arange(len(asked)) - np.searchsorted(asked, asked)
        best = place < k
        parts.append(
            pd.DataFrame(
                {
                    "query_id": query_ids[start + asked[best]],
                    "neighbour_id": ids[found[best]],
                    "label": labels[found[best]],
                    "distance": gap[best],
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def k_nearest(
    queries: DataFrame,
    train: DataFrame,
    k: int = 5,
    p: float = 2,
    metric: str = "minkowski",
    identifier: str = "doc_id",
    features: str = "features",
    target: str = "target",
    broadcast_numbers: int | None = None,
) -> DataFrame:
    """The k nearest training rows of each query.

    Returns query_id, neighbour_id, label, distance, rank. No pair of rows
    leaves a task: each task reduces what it sees to k rows per query. Queries
    of a checked size go to the training partitions, which are not shuffled; a
    larger set meets the training rows by pivots. The final ranking
    limits each query to k rows per task before its shuffle. A query set of at
    most ``broadcast_numbers`` numbers is broadcast. Distances are
    rounded to nine digits so that ties do not depend on summation order.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    p = METRICS[metric] or p
    asked = checkpointed(
        queries.select(F.col(identifier).alias("id"), as_array(queries, features).alias("v"))
    )
    known = train.select(
        F.col(identifier).alias("id"),
        as_array(train, features).alias("v"),
        F.col(target).cast("int").alias("label"),
    )
    id_type = queries.schema[identifier].dataType.simpleString()
    schema = f"query_id {id_type}, neighbour_id {id_type}, label int, distance double"
    n_queries, widest = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    most = BROADCAST_NUMBERS if broadcast_numbers is None else broadcast_numbers
    if n_queries * max(1, widest or 1) <= most:
        taken = asked.toPandas()
        given = asked.sparkSession.sparkContext.broadcast(
            (taken["id"].to_numpy(), matrix(taken["v"]) if len(taken) else np.empty((0, 1)))
        )

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            query_ids, points = given.value
            kept = None
            for batch in batches:
                if not len(batch) or not len(points):
                    continue
                found = nearest(
                    query_ids, points, batch["id"].to_numpy(), batch["label"].to_numpy(),
                    matrix(batch["v"]), k, p,
                )
                if kept is not None:
                    found = pd.concat([kept, found], ignore_index=True)
                    found = found.sort_values(["query_id", "distance", "neighbour_id"])
                    found = found.groupby("query_id", sort=False).head(k)
                kept = found
            if kept is not None:
                yield kept

        # Each task may send k rows per query, so tasks are limited such that all
        # of them together send no more rows than there are training rows.
        cores = asked.sparkSession.sparkContext.defaultParallelism
        tasks = max(2 * cores, known.count() // max(1, k * n_queries))
        candidates = known.coalesce(tasks).mapInPandas(scan, schema)
    else:
        candidates = by_pivots(asked, known, k, p, schema, widest)
    place = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return candidates.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


class Pivots:
    """Pivots, and when they are measured, the rows and radii of their cells."""

    def __init__(self, points: np.ndarray, p: float):
        self.points, self.p = points, p
        self.counts = np.zeros(len(points), np.int64)
        self.inner = np.full(len(points), math.inf)
        self.outer = np.full(len(points), -math.inf)

    def gaps(self, rows: np.ndarray) -> np.ndarray:
        """A metric between rows and pivots: the distance, or for p < 1 its p-th power."""
        out = np.empty((len(rows), len(self.points)))
        step = max(1, WORKING_NUMBERS // max(1, self.points.size))
        for start in range(0, len(rows), step):
            gap = np.abs(rows[start : start + step, None, :] - self.points[None, :, :])
            out[start : start + step] = self.metric((gap**self.p).sum(axis=2))
        return out

    def metric(self, powers: np.ndarray) -> np.ndarray:
        return powers if self.p < 1 else powers ** (1.0 / self.p)

    def home(self, gaps: np.ndarray, k: int) -> np.ndarray:
        """Per query and cell, whether the first pass visits it."""
        order = np.argsort(gaps, axis=1, kind="stable")
        held = np.cumsum(self.counts[order], axis=1)
        before = held - self.counts[order]
        visited = np.zeros(gaps.shape, bool)
        np.put_along_axis(visited, order, (before < k) & (self.counts[order] > 0), axis=1)
        return visited

    def open(self, gaps: np.ndarray, limit: np.ndarray, k: int) -> np.ndarray:
        """Per query and cell, whether the second pass visits it: rows within ``limit`` may be there."""
        reach = (limit if self.p >= 1 else limit**self.p)[:, None]
        reach = reach * (1 + 1e-9) + 1e-8  # of rounding
        inside = (gaps - self.outer <= reach) & (self.inner - gaps <= reach)
        nearest = np.where(self.counts > 0, gaps, math.inf).min(axis=1, keepdims=True)
        inside &= (gaps - nearest) / 2 <= reach
        return inside & (self.counts > 0) & ~self.home(gaps, k)


def chosen_pivots(known: DataFrame, widest: int, p: float) -> Pivots:
    """The training rows with the smallest hashes of their ids."""
    n = known.count()
    most = min(math.ceil(n / CELL_ROWS), math.isqrt(n), BROADCAST_NUMBERS // max(1, widest))
    most = max(1, most)
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    share = min(1.0, 1.2 * most / max(1, n) + 30 / max(1, n))
    drawn = known.filter(draw < int(share * (1 << 30))).select(draw.alias("draw"), "id", "v")
    rows = sorted(drawn.limit(2 * most + 200).collect(), key=lambda r: (r["draw"], str(r["id"])))
    return Pivots(matrix([r["v"] for r in rows[:most]]), p)


def celled(known: DataFrame, pivots: Pivots) -> DataFrame:
    """Training rows with their cell and their distance to its pivot, written once; measures the
    cells."""
    given = known.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                gaps = given.value.gaps(matrix(batch["v"]))
                cell = gaps.argmin(axis=1)
                yield batch.assign(cell=cell, gap=gaps[np.arange(len(batch)), cell])

    schema = StructType(
        [*known.schema, StructField("cell", LongType()), StructField("gap", DoubleType())]
    )
    rows = checkpointed(known.mapInPandas(assign, schema))
    measured = rows.groupBy("cell").agg(F.count("*"), F.min("gap"), F.max("gap"))
    for cell, n, inner, outer in measured.collect():  # a row per pivot
        pivots.counts[cell], pivots.inner[cell], pivots.outer[cell] = n, inner, outer
    return rows


def visits(asked: DataFrame, pivots: Pivots, k: int, limits: DataFrame | None = None) -> DataFrame:
    """A row per query and cell to visit: of the first pass, or with ``limits`` (id, limit) of the
    second."""
    given = asked.sparkSession.sparkContext.broadcast(pivots)
    if limits is not None:
        asked = asked.join(limits, "id")
    wanted = StructType([*asked.schema, StructField("cell", LongType())])

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, WORKING_NUMBERS // max(1, len(given.value.points)))
        for batch in batches:
            for start in range(0, len(batch), step):
                part = batch.iloc[start : start + step]
                gaps = given.value.gaps(matrix(part["v"]))
                if "limit" in part:
                    to = given.value.open(gaps, part["limit"].to_numpy(float), k)
                else:
                    to = given.value.home(gaps, k)
                query, cell = np.nonzero(to)
                for at in range(0, len(query), 10_000):
                    some = part.iloc[query[at : at + 10_000]]
                    yield some.assign(cell=cell[at : at + 10_000])

    return asked.mapInPandas(spread, wanted).select("id", "v", "cell")


def met(asked: DataFrame, rows: DataFrame, k: int, p: float, schema: str) -> DataFrame:
    """The k nearest rows of each query in each block of the cells that it visits."""
    asked = checkpointed(asked)

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias(name))

    def every(column: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(column) - 1))

    counts, small = settled(blocks(asked, "_asked").join(blocks(rows, "_rows"), "cell"))
    counts = F.broadcast(counts) if small else counts
    left = asked.join(counts, "cell").select(
        "id", "v", "cell", F.pmod(F.xxhash64("id"), F.col("_asked")).alias("a"), every("_rows").alias("b")
    )
    right = rows.join(counts, "cell").select(
        "id", "v", "label", "cell", every("_asked").alias("a"),
        F.pmod(F.xxhash64("id"), F.col("_rows")).alias("b"),
    )

    def meet(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame(columns=["query_id", "neighbour_id", "label", "distance"])
        return nearest(
            queries["id"].to_numpy(), matrix(queries["v"]), block["id"].to_numpy(),
            block["label"].to_numpy(), matrix(block["v"]), k, p,
        )

    key = ("cell", "a", "b")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(meet, schema)


def by_pivots(
    asked: DataFrame, known: DataFrame, k: int, p: float, schema: str, widest: int
) -> DataFrame:
    """Candidates that are sure to hold the k nearest training rows of each query."""
    # Of equal rows only the k smallest ids can be among the k nearest.
    first = Window.partitionBy("v").orderBy("id")
    known = checkpointed(
        known.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= k).drop("_n")
    )
    if known.isEmpty():
        return asked.sparkSession.createDataFrame([], schema)
    pivots = chosen_pivots(known, widest, p)
    rows = celled(known, pivots)
    near = checkpointed(met(visits(asked, pivots, k), rows, k, p, schema))
    place = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    best = near.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= k)
    limit = F.when(F.count("*") == k, F.max("distance")).otherwise(float("inf"))
    limits = best.groupBy(F.col("query_id").alias("id")).agg(limit.alias("limit"))
    return near.unionByName(met(visits(asked, pivots, k, limits), rows, k, p, schema))


def votes(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """Weight of each label among a query's neighbours: query_id, label, vote.

    ``distance`` weighs by 1/d; if some neighbours are at distance zero only
    those count.
    """
    if weights == "uniform":
        weighed = neighbours.withColumn("_w", F.lit(1.0))
    elif weights == "distance":
        closest = F.min("distance").over(Window.partitionBy("query_id"))
        exact = (F.col("distance") == 0).cast("double")
        weighed = neighbours.withColumn(
            "_w", F.when(closest == 0, exact).otherwise(F.try_divide(F.lit(1.0), F.col("distance")))
        )
    else:
        raise ValueError(f"unknown weights: {weights}")
    return weighed.groupBy("query_id", "label").agg(F.sum("_w").alias("vote"))


def knn_predict(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """The label with the largest vote, the smallest one on a tie."""
    best = F.max(F.struct(F.round("vote", 9).alias("vote"), (-F.col("label")).alias("label")))
    return (
        votes(neighbours, weights)
        .groupBy("query_id")
        .agg(best.alias("_best"))
        .select("query_id", (-F.col("_best.label")).alias("prediction"))
    )


def class_shares(classes: Sequence[int]) -> list[Column]:
    """Per class, its share of a query's votes."""
    total = F.sum("vote")
    return [
        F.coalesce(F.sum(F.when(F.col("label") == c, F.col("vote"))) / total, F.lit(0.0))
        for c in classes
    ]


def knn_proba(
    neighbours: DataFrame, classes: Sequence[int], weights: str = "uniform"
) -> DataFrame:
    """Normalised votes over the classes, in their order: query_id, probability."""
    return (
        votes(neighbours, weights)
        .groupBy("query_id")
        .agg(F.array(*class_shares(classes)).alias("probability"))
    )
