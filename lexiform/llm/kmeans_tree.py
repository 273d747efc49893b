"""Nearest neighbours by inner product, with a hierarchical k-means tree.

Vectors are divided by the largest norm and get one more component that makes all of them as long as
that: then the largest inner product is the smallest distance. A tree of k-means with 16 branches is
fitted on a sample of bounded size, and every vector descends to its leaf. A query goes through the
tree best bin first: it descends to the nearest child, keeps the others in a priority queue by their
distance, and goes on with the nearest of all that were left, so it meets the leaves in an order of
its own.

How many leaves are visited is calibrated. The exact neighbours of some queries are found among all
vectors, and visits are widened until the leaves hold the wanted share of them. Leaves are joined
with the queries that visit them, in blocks of bounded size and in rounds: after its first leaves a
query knows what a row must score, and wider rounds return only rows that do.

Copies share the work: a vector is searched for once, whoever asks, and of the rows that hold the
same vector only the k + 1 smallest keys can be among the k nearest of any query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from lexiform.cluster import fresh_path, settled
from lexiform.llm.batches import record_batch

BRANCHES = 16
LEAF_ROWS = 500  # vectors of a leaf, until the sample allows no more leaves
SAMPLE_ROWS = 131_072  # vectors that the tree is fitted on, at most
SAMPLE_BYTES = 64_000_000
LEAF_SAMPLE = 16  # sampled vectors of a leaf
ROUNDS = 8  # of k-means at a node
CALIBRATION = 256  # queries whose exact neighbours are found
RECALL = 0.94  # share of these that the visited leaves hold
FIRST_VISITS = 2  # leaves of the first round, and
WIDENING = 4  # how many times as many have been visited after each further one
BLOCK_ROWS = 4_096

ROWS = StructType(
    [
        StructField("key", LongType()),
        StructField("size", LongType()),
        StructField("norm", DoubleType()),
        StructField("vector", BinaryType()),
    ]
)


def matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, the same for the same rows wherever they stand."""
    return (a * b).sum(1)


class KMeansTree:
    """Nodes in the order of their making, children of a node one after the other."""

    def __init__(self, rows: np.ndarray, leaves: int, norm: float, branches: int = BRANCHES):
        self.norm = norm
        points = self.lifted(rows)
        rng = np.random.default_rng(12)
        centres, self.first, self.count = [points.mean(0)], [0], [0]
        queue = [(0, np.arange(len(points)), leaves)]
        for node, at, wanted in queue:
            k = min(branches, wanted, len(at) // LEAF_SAMPLE)
            groups = _clusters(points[at], k, rng) if k > 1 else []
            if len(groups) < 2:
                continue
            self.first[node], self.count[node] = len(centres), len(groups)
            for centre, members in groups:
                share = max(1, round(wanted * len(members) / len(at)))
                queue.append((len(centres), at[members], share))
                centres.append(centre)
                self.first.append(0)
                self.count.append(0)
        self.centres = np.array(centres, np.float32)
        self.squares = (self.centres**2).sum(1)
        self.leaf = np.cumsum(np.array(self.count) == 0) - 1
        self.leaves = int(self.leaf[-1]) + 1

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        """Rows of norm 1 whose distances order the inner products."""
        scaled = rows / self.norm
        rest = np.sqrt(np.maximum(1 - (scaled**2).sum(1), 0))
        return np.column_stack([scaled, rest]).astype(np.float32)

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        points, node = self.lifted(rows), np.zeros(len(rows), np.int64)
        active = {0: np.arange(len(rows))}
        while active:
            at, members = active.popitem()
            node[members] = at
            if self.count[at]:
                own = slice(self.first[at], self.first[at] + self.count[at])
                far = self.squares[own] - 2 * points[members] @ self.centres[own].T
                child = far.argmin(1)
                for c in np.unique(child).tolist():
                    active[self.first[at] + c] = members[child == c]
        return self.leaf[node]

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first leaves that a query meets, best bin first."""
        point = np.append(query / np.linalg.norm(query), 0).astype(np.float32)
        queue, met = [(0.0, 0)], []
        while queue and len(met) < most:
            node = heapq.heappop(queue)[1]
            while self.count[node]:
                first = self.first[node]
                own = slice(first, first + self.count[node])
                far = (self.squares[own] - 2 * self.centres[own] @ point).tolist()
                nearest = min(range(len(far)), key=far.__getitem__)
                for child, distance in enumerate(far):
                    if child != nearest:
                        heapq.heappush(queue, (distance, first + child))
                node = first + nearest
            met.append(int(self.leaf[node]))
        return met


def _clusters(points: np.ndarray, k: int, rng) -> list[tuple[np.ndarray, np.ndarray]]:
    """Centres and members of at most k clusters."""
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(ROUNDS):
        own = ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)
        held = np.unique(own)
        chosen = (own == held[:, None]).astype(np.float32)
        centres = chosen @ points / chosen.sum(1, keepdims=True)
    own = ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)
    return [(centres[c], np.flatnonzero(own == c)) for c in np.unique(own).tolist()]


class Nearest:
    """The k nearest rows of each of some queries, from one batch of rows to the next."""

    def __init__(self, queries: np.ndarray, k: int, floors: np.ndarray | None = None):
        """Rows below its floor are no use to a query."""
        self.queries, self.k = queries, k
        self.floors = np.full(len(queries), -math.inf) if floors is None else floors
        self.found: list[list[tuple]] = [[] for _ in queries]

    def add(self, keys: np.ndarray, rows: np.ndarray, extra: np.ndarray) -> None:
        """``extra`` is carried along with each row."""
        slack = 1e-13 * rows.shape[1] * np.abs(rows).max(initial=0)
        for start in range(0, len(rows), BLOCK_ROWS):
            part = slice(start, start + BLOCK_ROWS)
            for i, about in enumerate(self.queries @ rows[part].T):
                best, query = self.found[i], self.queries[i]
                floor = self.floors[i]
                least = floor if len(best) < self.k else max(floor, -best[-1][0])
                if len(about) > self.k:
                    least = max(least, np.partition(about, -self.k)[-self.k])
                # About, as sums in another order differ in their last digits.
                at = np.flatnonzero(about >= least - slack * (np.abs(query).max() + 1)) + start
                if len(at):
                    exact = products(rows[at], query[None, :])
                    at, exact = at[exact >= floor], exact[exact >= floor]
                    best += zip((-exact).tolist(), keys[at].tolist(), extra[at].tolist())
                    best.sort()
                    del best[self.k :]


def nearest(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """For each row whose key is divisible by ``every`` the ``k`` rows of largest inner product
    found: query_id, rank from 1, key, score.

    All other rows are candidates. Scores are sums in double precision over the vectors as they are;
    equal scores are ranked by key. Rows whose key or vector is null and vectors that are empty, zero or hold null or
    non-finite components take no part. Rows that repeat key and vector are one; several vectors
    under one key are queries and candidates of their own. Vectors meet those of their own length:
    the tree serves the most frequent length, all others are searched exactly. With fewer
    candidates than ``k`` all are returned, empty tables give no rows, other columns are not read.
    """
    spark = vectors.sparkSession
    rows = _unique(vectors, key, vector)
    main = rows.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if main is None:
        return spark.createDataFrame(
            [], f"query_id bigint, rank int, {key} bigint, score double"
        )
    size, n_rows = main
    asked = rows.filter(F.pmod("key", F.lit(every)) == 0)
    tree = spark.sparkContext.broadcast(_fitted(rows.filter(F.col("size") == size), size, n_rows))

    # Of equal vectors the k + 1 smallest keys; a query may hold one of them itself.
    first = Window.partitionBy("same").orderBy("key")
    placed = StructType(
        [
            StructField("cell", LongType()),
            StructField("key", LongType()),
            StructField("vector", BinaryType()),
        ]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = -batch.column("size").to_numpy()
            at = np.flatnonzero(cell == -size)
            if len(at):
                held = batch.column("vector").take(pa.array(at)).to_pylist()
                cell = cell.copy()
                cell[at] = tree.value.assign(matrix(held))
            yield record_batch(placed, {**dict(zip(batch.schema.names, batch.columns)), "cell": cell})

    folder = fresh_path(spark, "cells")
    (
        rows.withColumn("n", F.row_number().over(first))
        .filter(F.col("n") <= k + 1)
        .select("key", "size", "vector")
        .mapInArrow(place, placed)
        .write.parquet(folder)
    )
    cells = spark.read.schema(placed).parquet(folder)

    distinct = asked.groupBy("same").agg(F.first("vector").alias("vector"), F.first("size").alias("size"))
    folder = fresh_path(spark, "queries")
    distinct.write.parquet(folder)
    distinct = spark.read.parquet(folder)
    width = _calibrated(distinct.filter(F.col("size") == size), cells, tree, size, k, recall)

    visiting = StructType(
        [
            StructField("cell", LongType()),
            StructField("turn", LongType()),
            StructField("same", StringType()),
            StructField("vector", BinaryType()),
        ]
    )

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("vector").to_pylist()
            cell, turn, at = [], [], []
            for i, n in enumerate(batch.column("size").to_pylist()):
                met = [-n]
                if n == size:
                    met = tree.value.visits(np.frombuffer(held[i], "<f8"), width)
                cell += met
                turn += range(len(met))
                at += [i] * len(met)
            for start in range(0, len(at), 10_000):
                some = slice(start, start + 10_000)
                part = pa.array(at[some])
                yield record_batch(
                    visiting,
                    {
                        "cell": cell[some],
                        "turn": turn[some],
                        "same": batch.column("same").take(part),
                        "vector": batch.column("vector").take(part),
                    },
                )

    best = _widened(cells, distinct.mapInArrow(visit, visiting), width, k + 1)
    best = best.groupBy("same").agg(
        F.array_sort(F.collect_list(F.struct("n", "key", "copy", "score"))).alias("best")
    )
    own = lambda b: b["copy"] & (b["key"] == F.col("query_id"))
    others = F.slice(F.filter("best", lambda b: ~own(b)), 1, k)
    return (
        asked.select(F.col("key").alias("query_id"), "same")
        .join(best, "same")
        .select("query_id", F.posexplode(others).alias("place", "b"))
        .select(
            "query_id", (F.col("place") + 1).alias("rank"), F.col("b.key").alias(key),
            F.col("b.score").alias("score"),
        )
    )


def _unique(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Usable rows, each key and vector once: key, same, size, norm, vector."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, norms, held = [], [], [], []
            for k, v in zip(batch.column("key").to_pylist(), batch.column("vector").to_pylist()):
                if k is None or not v or None in v:
                    continue
                x = np.asarray(v, "<f8") + 0.0  # no negative zeros
                most = np.abs(x).max()
                if most > 0 and np.isfinite(x).all():
                    keys.append(k)
                    sizes.append(len(x))
                    norms.append(min(float(most) * float(np.linalg.norm(x / most)), 1e308))
                    held.append(x.tobytes())
            yield record_batch(ROWS, {"key": keys, "size": sizes, "norm": norms, "vector": held})

    spark = vectors.sparkSession
    folder = fresh_path(spark, "vectors")
    (
        vectors.select(F.col(key).cast("bigint").alias("key"), F.col(vector).alias("vector"))
        .mapInArrow(pack, ROWS)
        .withColumn("same", F.md5("vector"))
        .groupBy("key", "same")
        .agg(*(F.first(c).alias(c) for c in ("size", "norm", "vector")))
        .write.parquet(folder)
    )
    return spark.read.parquet(folder)


def _fitted(rows: DataFrame, size: int, n_rows: int) -> KMeansTree:
    """A tree on the sample of the vectors with the smallest hashes."""
    most = max(BRANCHES, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    draw = F.pmod(F.xxhash64("key", "same"), F.lit(1 << 30))
    share = min(1.0, 1.2 * most / n_rows + 30 / n_rows)
    drawn = rows.filter(draw < int(share * (1 << 30))).select(draw.alias("draw"), "key", "vector")
    drawn = sorted(drawn.limit(2 * most).collect(), key=lambda r: (r["draw"], r["key"]))[:most]
    norm = rows.agg(F.max("norm")).first()[0]
    leaves = max(1, min(n_rows // LEAF_ROWS, len(drawn) // LEAF_SAMPLE))
    return KMeansTree(matrix([bytes(r["vector"]) for r in drawn]), leaves, norm)


def _calibrated(queries: DataFrame, cells: DataFrame, tree, size: int, k: int, recall: float) -> int:
    """Visits of a query with which the leaves hold this share of the exact neighbours."""
    most = max(1, min(CALIBRATION, 8_000_000 // (8 * size)))
    leaves = tree.value.leaves
    chosen = queries.orderBy(F.xxhash64("same"), "same").limit(most).collect()
    if not chosen or leaves == 1:
        return 1
    wanted = matrix([bytes(r["vector"]) for r in chosen])
    held = queries.sparkSession.sparkContext.broadcast(wanted)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Nearest(held.value, k + 1)
        for batch in batches:
            if batch.num_rows:
                best.add(
                    batch.column("key").to_numpy(),
                    matrix(batch.column("vector").to_pylist()),
                    batch.column("cell").to_numpy(),
                )
        rows = [(i, -s, key, c) for i, found in enumerate(best.found) for s, key, c in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in zip(*rows)], names=["query", "score", "key", "cell"]
            )

    order = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    exact = (
        cells.filter("cell >= 0")
        .mapInArrow(search, "query bigint, score double, key bigint, cell bigint")
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n").between(2, k + 1))  # the first is most often the query itself
        .groupBy("query", "cell").count().collect()
    )
    held.unpersist()
    # How many neighbours each further visit adds, over all queries.
    gained = np.zeros(leaves, np.int64)
    turn = {}
    for query, cell, n in exact:
        if query not in turn:
            met = tree.value.visits(wanted[query], leaves)
            turn[query] = {c: i for i, c in enumerate(met)}
        gained[turn[query][cell]] += n
    share = np.cumsum(gained) / max(1, gained.sum())
    return int(np.searchsorted(share, recall)) + 1


def _widened(cells: DataFrame, visits: DataFrame, width: int, k: int) -> DataFrame:
    """(same, key, copy, score, n): the k best of each query over all its visits, round by round."""
    spark = cells.sparkSession
    folder = fresh_path(spark, "visits")
    visits.write.parquet(folder)
    visits = spark.read.schema(visits.schema).parquet(folder)
    order = Window.partitionBy("same").orderBy(F.desc("score"), "key")
    best, first, last = None, 0, FIRST_VISITS
    while best is None or first < width:
        now = visits.filter(F.col("turn").between(first, last - 1))
        if best is None:
            now = now.withColumn("floor", F.lit(-math.inf))
            found = _searched(cells, now, k)
        else:
            floor = best.filter(F.col("n") == k).select("same", F.col("score").alias("floor"))
            now = now.join(floor, "same", "left").fillna(-math.inf, "floor")
            found = _searched(cells, now, k).unionByName(best.drop("n"))
        folder = fresh_path(spark, "best")
        ranked = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
        ranked.write.parquet(folder)
        best = spark.read.schema(ranked.schema).parquet(folder)
        first, last = last, last * WIDENING
    return best


def _searched(cells: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """(same, key, copy, score): the k nearest of each query in each block of the cells that it
    visits, none below its floor, and whether they hold the query's vector."""

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias(name))

    counted, small = settled(blocks(cells, "a_blocks").join(blocks(visits, "b_blocks"), "cell"))
    counted = F.broadcast(counted) if small else counted
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = cells.join(counted, "cell").select(
        "cell", F.pmod(F.xxhash64("key"), F.col("a_blocks")).alias("a"), every("b_blocks").alias("b"),
        "key", "vector",
    )
    right = visits.join(counted, "cell").select(
        "cell", every("a_blocks").alias("a"), F.pmod(F.xxhash64("same"), F.col("b_blocks")).alias("b"),
        "same", "floor", "vector",
    )

    def meet(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        held, asking = rows["vector"].tolist(), queries["vector"].tolist()
        if not held or not asking:
            return pd.DataFrame({"same": [], "key": [], "copy": [], "score": []})
        best = Nearest(matrix(asking), k, queries["floor"].to_numpy(float))
        best.add(rows["key"].to_numpy(np.int64), matrix(held), np.arange(len(held)))
        same = queries["same"].tolist()
        out = [
            (same[i], key, held[j] == asking[i], -s)
            for i, found in enumerate(best.found)
            for s, key, j in found
        ]
        return pd.DataFrame(out, columns=["same", "key", "copy", "score"])

    return (
        left.groupBy("cell", "a", "b").cogroup(right.groupBy("cell", "a", "b"))
        .applyInPandas(meet, "same string, key bigint, copy boolean, score double")
    )
