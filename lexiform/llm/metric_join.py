"""Exact join of embeddings by cosine, as a metric range join.

Between unit vectors a cosine of at least t is a Euclidean distance of at most r = sqrt(2 - 2t).
Pivots partition the vectors of a label: a vector's home is the cell of its nearest pivot p. If x, at
home in cell j, lies within r of a vector at home in cell i, then by the triangle inequality
|x - p_i| <= |x - p_j| + 2r, and x is at most r away from the plane half way between the two pivots;
x is replicated to the cells where both hold. Every vector then meets all its neighbours in its home
cell, and cells are joined independently. A cell too large for one task is joined as pairs of blocks,
so neither hot cells nor hot labels gather in a task.

Copies of a vector are joined once, by a representative. Cells return counts and, instead of pairs,
one link per vector to the smallest it is connected with in the task.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from lexiform.cluster import fresh_path
from lexiform.llm.batches import record_batch
from lexiform.llm.components import components

THRESHOLD = 0.93
CELL_ROWS = 2_000  # vectors for which there is one pivot, until MAX_PIVOTS
MAX_PIVOTS = 4_096  # of all labels together; they are broadcast
BLOCK_ROWS = 4_096
SLACK = 1e-9  # of rounding, in the replication test


def unit_rows(values: list[bytes]) -> np.ndarray:
    """Vectors of doubles as unit rows."""
    rows = np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Cells:
    """Pivots by label, numbered over all labels."""

    def __init__(self, pivots: dict[int, tuple[int, np.ndarray]], radius: float):
        self.pivots, self.radius = pivots, radius

    def assign(self, label: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Home of each row, a matrix of the cells that each row belongs to, and the first cell."""
        first, pivots = self.pivots[label]
        distance = np.sqrt(np.maximum(2 - 2 * rows @ pivots.T, 0))
        home = distance.argmin(1)
        nearest = distance[np.arange(len(rows)), home]
        apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))[home]
        inside = distance <= nearest[:, None] + 2 * self.radius + SLACK
        to_plane = (distance**2 - nearest[:, None] ** 2) / np.maximum(2 * apart, 1e-12)
        inside &= (to_plane <= self.radius + SLACK) | (apart < 1e-6)
        inside[np.arange(len(rows)), home] = True
        return home, inside, first


def by_label(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(label, representatives, copies, unit rows) of a batch, label by label."""
    labels = batch.column("label").to_numpy(zero_copy_only=False)
    reps = batch.column("rep").to_numpy(zero_copy_only=False)
    copies = batch.column("copies").to_numpy(zero_copy_only=False)
    vectors = batch.column("vector").to_pylist()
    for label in np.unique(labels).tolist():
        at = np.flatnonzero(labels == label)
        for some in np.array_split(at, math.ceil(len(at) / 2000)):
            yield label, reps[some], copies[some], unit_rows([vectors[i] for i in some])


def connected(links: np.ndarray, left: np.ndarray, right: np.ndarray):
    """The smallest id that each row and column of a link matrix is connected with."""
    smallest_left, smallest_right = left.copy(), right.copy()
    far = np.iinfo(np.int64).max
    while True:
        seen = np.empty_like(smallest_left)
        back = np.full(len(right), far)
        for i in range(0, len(left), 256):
            part = links[i : i + 256]
            seen[i : i + 256] = np.where(part, smallest_right, far).min(1, initial=far)
        new_left = np.minimum(smallest_left, seen)
        for i in range(0, len(left), 256):
            part = links[i : i + 256]
            back = np.minimum(back, np.where(part, new_left[i : i + 256, None], far).min(0, initial=far))
        new_right = np.minimum(smallest_right, back)
        if (new_left == smallest_left).all() and (new_right == smallest_right).all():
            return new_left, new_right
        smallest_left, smallest_right = new_left, new_right


def _join_blocks(threshold: float):
    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        home, other = rows[rows["home"]], rows[~rows["home"]]
        left, right = home["rep"].to_numpy(np.int64), other["rep"].to_numpy(np.int64)
        if not len(left) or not len(right):
            return pd.DataFrame({"rep": left[:0], "n": left[:0], "smallest": left[:0]})
        a, b = unit_rows(home["vector"].tolist()), unit_rows(other["vector"].tolist())
        copies = other["copies"].to_numpy(np.int64)
        links = np.zeros((len(left), len(right)), bool)
        counts = np.zeros(len(left), np.int64)
        for i in range(0, len(left), 256):
            part = (a[i : i + 256] @ b.T >= threshold) & (left[i : i + 256, None] != right)
            links[i : i + 256] = part
            counts[i : i + 256] = part @ copies
        smallest_left, smallest_right = connected(links, left, right)
        found, more = counts > 0, smallest_right != right
        return pd.DataFrame(
            {
                "rep": np.concatenate([left[found], right[more]]),
                "n": np.concatenate([counts[found], np.zeros(more.sum(), np.int64)]),
                "smallest": np.concatenate([smallest_left[found], smallest_right[more]]),
            }
        )

    return join


def range_join(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per row: key, n_links, component_id, kept.

    Two rows are linked if their labels are equal and their cosine is at least ``threshold``. Rows
    whose label or vector is null, whose vector is zero, empty or holds null or non-finite numbers,
    or whose key is null, link with nothing; so do vectors of different lengths. ``component_id`` is
    the smallest key that can be reached by links, ``kept`` whether it is the row's own. Repeated
    rows are vectors of their own; a key on different vectors does not link them. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    doubles = F.transform(F.col("vector"), lambda x: x.cast("double"))
    usable = (
        F.col("key").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    written = F.concat_ws(",", F.transform("vector", lambda x: x.cast("string")))
    rows = vectors.select(
        F.col(key).cast("bigint").alias("key"), F.col(label).cast("bigint").alias("label"),
        F.col(vector).alias("vector"),
    )
    rows = rows.withColumn("same", F.when(F.coalesce(usable, F.lit(False)), F.md5(written)))

    schema = StructType(
        [
            StructField("rep", LongType()),
            StructField("label", LongType()),
            StructField("same", StringType()),
            StructField("copies", LongType()),
            StructField("size", LongType()),
            StructField("vector", BinaryType()),
        ]
    )
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.asarray(v, "<f8") for v in batch.column("vector").to_pylist()]
            yield record_batch(
                schema,
                {
                    **{n: batch.column(n) for n in ("rep", "label", "same", "copies")},
                    "size": [len(v) for v in values],
                    "vector": [(v / np.abs(v).max()).tobytes() for v in values],
                },
            )

    folder = fresh_path(spark, "vectors")
    (
        rows.filter("same IS NOT NULL")
        .groupBy("label", "same")
        .agg(
            F.min("key").alias("rep"), F.count("*").alias("copies"),
            F.first(doubles).alias("vector"),
        )
        .mapInArrow(pack, schema)
        .write.parquet(folder)
    )
    reps = spark.read.schema(schema).parquet(folder)

    found = []
    sizes = [r[0] for r in reps.select("size").distinct().limit(1001).collect()]
    if len(sizes) > 1000:
        raise ValueError("vectors have more than 1000 different lengths")
    for size in sizes:
        found.append(_linked(reps.filter(F.col("size") == size), threshold, cell_rows, block_rows))
    info = reps.select("rep", "label", "same", "copies")
    if found:
        linked = found[0]
        for more in found[1:]:
            linked = linked.unionByName(more)
        folder = fresh_path(spark, "linked")
        linked.write.parquet(folder)
        linked = spark.read.parquet(folder)
        counts = linked.groupBy("rep").agg(F.sum("n").alias("n"))
        groups = components(linked.filter("rep <> smallest"), "rep", "smallest")
        info = info.join(counts, "rep", "left").join(
            groups.withColumnRenamed("node", "rep"), "rep", "left"
        )
    else:
        info = info.withColumns({"n": F.lit(0), "component": F.col("rep")})
    own = F.coalesce(F.col("component"), F.col("rep"), F.col("key"))
    return rows.select("key", "label", "same").join(info, ["label", "same"], "left").select(
        F.col("key").alias(key),
        F.coalesce(F.coalesce("n", F.lit(0)) + F.col("copies") - 1, F.lit(0))
        .cast("bigint").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("key") == own, F.lit(True)).alias("kept"),
    )


def _linked(reps: DataFrame, threshold: float, cell_rows: int, block_rows: int) -> DataFrame:
    """(rep, n, smallest): links counted part by part, and a link to what a part connects."""
    spark = reps.sparkSession
    totals = {r[0]: r[1] for r in reps.groupBy("label").count().limit(MAX_PIVOTS + 1).collect()}
    if len(totals) > MAX_PIVOTS:
        raise ValueError(f"more than {MAX_PIVOTS} labels")
    rows = max(cell_rows, math.ceil(sum(totals.values()) / (MAX_PIVOTS - len(totals) or 1)))
    # A label's pivots are the vectors with the smallest hashes.
    wanted = spark.createDataFrame(
        [(k, max(1, n // rows), n) for k, n in totals.items()], "label bigint, pivots int, n bigint"
    )
    share = F.col("pivots") * 3.0 / F.col("n") + 30.0 / F.col("n")
    draw = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) / float(1 << 30)
    drawn = (
        reps.join(F.broadcast(wanted), "label")  # at most MAX_PIVOTS rows
        .filter(draw <= share)
        .withColumn("draw", draw)
        .select("label", "rep", "vector", "pivots", "draw")
        .collect()
    )
    pivots: dict[int, list] = defaultdict(list)
    limit: dict[int, int] = {}
    for row in sorted(drawn, key=lambda r: (r["draw"], r["rep"])):
        limit[row["label"]] = row["pivots"]
        if len(pivots[row["label"]]) < row["pivots"]:
            pivots[row["label"]].append(bytes(row["vector"]))
    numbered, first = {}, 0
    for label in totals:
        held = unit_rows(pivots[label]) if pivots.get(label) else None
        if held is None:
            held = unit_rows([bytes(reps.filter(F.col("label") == label).first()["vector"])])
        numbered[label] = (first, held)
        first += len(held)
    cells = spark.sparkContext.broadcast(
        Cells(numbered, math.sqrt(max(0.0, 2 - 2 * threshold)))
    )

    sizes = StructType([StructField(n, LongType()) for n in ("cell", "homes", "members")])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, _, _, units in by_label(batch):
                home, inside, start = cells.value.assign(label, units)
                n = inside.shape[1]
                yield record_batch(
                    sizes,
                    {
                        "cell": np.arange(start, start + n),
                        "homes": np.bincount(home, minlength=n),
                        "members": inside.sum(0),
                    },
                )

    light = reps.select("rep", "label", "copies", "vector")
    counted = light.mapInArrow(measure, sizes).groupBy("cell").agg(F.sum("homes"), F.sum("members"))
    blocks = spark.sparkContext.broadcast(
        {
            r[0]: (max(1, math.ceil(r[1] / block_rows)), max(1, math.ceil(r[2] / block_rows)))
            for r in counted.collect()
        }
    )

    placed = StructType(
        [
            *(StructField(n, LongType()) for n in ("cell", "a", "b", "rep", "copies")),
            StructField("home", BooleanType()),
            StructField("vector", BinaryType()),
        ]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, reps_, copies, units in by_label(batch):
                home, inside, start = cells.value.assign(label, units)
                mixed = (reps_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
                out: list[tuple] = []
                for i, cell in zip(*(x.tolist() for x in np.nonzero(inside))):
                    n_a, n_b = blocks.value[start + cell]
                    key, data = int(mixed[i]), units[i].tobytes()
                    own_a, own_b = key % n_a, key % n_b
                    rep, copy = int(reps_[i]), int(copies[i])
                    out += [(start + cell, a, own_b, rep, copy, False, data) for a in range(n_a)]
                    if home[i] == cell:
                        out += [(start + cell, own_a, b, rep, copy, True, data) for b in range(n_b)]
                    if len(out) >= 5000:
                        yield record_batch(placed, dict(zip(placed.names, zip(*out))))
                        out = []
                if out:
                    yield record_batch(placed, dict(zip(placed.names, zip(*out))))

    return (
        light.mapInArrow(place, placed)
        .groupBy("cell", "a", "b")
        .applyInPandas(_join_blocks(threshold), "rep bigint, n bigint, smallest bigint")
    )
