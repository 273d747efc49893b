"""Points that no other point dominates, over columns of which more is better.

Of two columns the answer is a running maximum: values of the first are dealt out by range, and each
is told the highest second value of all greater ones. More columns are cut at quantiles into a grid.
Whole cells are decided by their places; what is left is reduced inside bounded blocks, and a block
meets only blocks of cells that may dominate it, rows only where the cell's corner says so.

A null is an unknown value: points are compared over the columns that both know, and not at all if
there are none. Strict: to dominate is to be greater in all of them. Weak: nowhere less and somewhere
greater.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lexiform.cluster import checkpointed, settled

# Cells of a grid at most, and rows that are compared with each other in a task.
CELLS = 8_192
BLOCK_ROWS = 4_096

# Distinct values of the first of two columns in a bucket of the running maximum.
BUCKET_VALUES = 65_536

# Numbers held at once while points are compared.
WORKING_NUMBERS = 4_000_000


def beaten(rows: np.ndarray, others: np.ndarray, weak: bool) -> np.ndarray:
    """Which rows are dominated by one of the others."""
    out = np.zeros(len(rows), dtype=bool)
    step = max(1, WORKING_NUMBERS // max(1, others.size))
    for start in range(0, len(rows), step):
        mine, theirs = rows[start : start + step, None, :], others[None, :, :]
        unknown = np.isnan(mine) | np.isnan(theirs)
        shared = ~unknown.all(axis=2)
        if weak:
            wins = ((theirs >= mine) | unknown).all(axis=2) & (theirs > mine).any(axis=2)
        else:
            wins = ((theirs > mine) | unknown).all(axis=2) & shared
        out[start : start + step] = wins.any(axis=1)
    return out


def local_frontier(values: np.ndarray, weak: bool) -> np.ndarray:
    """Which rows no other row with the same known values dominates.

    Dominance is transitive only between points that know the same columns, so only those may
    eliminate each other before all have been compared.
    """
    keep = np.ones(len(values), dtype=bool)
    patterns, kind = np.unique(np.isnan(values), axis=0, return_inverse=True)
    for i, pattern in enumerate(patterns):
        members = np.flatnonzero(kind.ravel() == i)
        shown = values[members][:, ~pattern]
        members = members[np.argsort(-shown.sum(axis=1), kind="stable")]
        front = np.empty((0, values.shape[1]))
        for start in range(0, len(members), 1024):
            block = members[start : start + 1024]
            alive = block[~beaten(values[block], front, weak)] if len(front) else block
            alive = alive[~beaten(values[alive], values[alive], weak)]
            front = np.vstack([front, values[alive]])
            keep[np.setdiff1d(block, alive)] = False
    return keep


def skyline(rows: DataFrame, scores: Sequence[Column], weak: bool = False) -> DataFrame:
    """The rows whose scores no other row's scores dominate; rows that know no score are left out.

    Any number of rows may tie.
    """
    names = [f"_s{i}" for i in range(len(scores))]
    marked = rows.withColumns(dict(zip(names, scores))).filter(F.coalesce(*names).isNotNull())
    if len(names) == 1:
        best = marked.agg(F.max(names[0])).first()[0]
        kept = marked.filter(F.col(names[0]) == best)
    elif len(names) == 2:
        kept = _of_two(marked, weak)
    else:
        points = _of_many(marked.select(*names).distinct(), names, weak)
        points, small = settled(points.select([F.col(n).alias(f"_{n}") for n in names]))
        same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names])
        kept = marked.join(F.broadcast(points) if small else points, same, "left_semi")
    return kept.drop(*names)


def _of_two(marked: DataFrame, weak: bool) -> DataFrame:
    x, y = F.col("_s0"), F.col("_s1")
    top = marked.agg(
        F.max("_s0").alias("x"), F.max("_s1").alias("y"),
        F.max(F.when(y.isNull(), x)).alias("only_x"), F.max(F.when(x.isNull(), y)).alias("only_y"),
    ).first()
    steps = running_maximum(marked.filter(x.isNotNull() & y.isNotNull()), "_s0", "_s1")
    # Values of x at which some point stands.
    if weak:
        steps = steps.filter("_ahead IS NULL OR _top > _ahead")
        fits = y == F.col("_top")
    else:
        steps = steps.filter("_ahead IS NULL OR _top >= _ahead")
        fits = F.col("_ahead").isNull() | (y >= F.col("_ahead"))
    steps, small = settled(steps)
    joined = marked.join(F.broadcast(steps) if small else steps, "_s0", "left")

    def reaches(column: Column, best: float | None) -> Column:
        return F.lit(True) if best is None else column >= F.lit(best)

    both = fits & F.col("_top").isNotNull() & reaches(x, top["only_x"]) & reaches(y, top["only_y"])
    alive = (
        F.when(y.isNull(), reaches(x, top["x"])).when(x.isNull(), reaches(y, top["y"])).otherwise(both)
    )
    return joined.filter(alive).select(*marked.columns)


def running_maximum(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Per value of x: its highest y (_top) and the highest y of all greater x (_ahead, or null).

    Values are dealt out by range to tasks of bounded size; a task needs of the others their
    maximum alone.
    """
    tops = checkpointed(rows.groupBy(x).agg(F.max(y).alias("_top")))
    buckets = max(1, math.ceil(tops.count() / BUCKET_VALUES))
    dealt = checkpointed(
        tops.repartitionByRange(buckets, x).withColumn("_bucket", F.spark_partition_id())
    )
    greater = Window.orderBy("_bucket").rowsBetween(1, Window.unboundedFollowing)
    later = dealt.groupBy("_bucket").agg(F.max("_top").alias("_most"))
    later, small = settled(later.select("_bucket", F.max("_most").over(greater).alias("_later")))
    inside = Window.partitionBy("_bucket").orderBy(F.desc(x)).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.join(F.broadcast(later) if small else later, "_bucket")
        .withColumn("_ahead", F.greatest(F.max("_top").over(inside), "_later"))
        .select(x, "_top", "_ahead")
    )


class Grid:
    """Cells between quantiles: a point's place along a column is the number of edges below it, -1 if
    it is unknown."""

    def __init__(self, edges: list[np.ndarray]):
        self.edges = edges
        self.widths = [len(e) + 2 for e in edges]

    def cells(self, values: np.ndarray) -> np.ndarray:
        code = np.zeros(len(values), np.int64)
        for i, edges in enumerate(self.edges):
            column = values[:, i]
            place = np.where(np.isnan(column), 0, np.searchsorted(edges, column) + 1)
            code = code * self.widths[i] + place
        return code

    def places(self, cells: np.ndarray) -> np.ndarray:
        out = np.zeros((len(cells), len(self.edges)))
        for i in range(len(self.edges) - 1, -1, -1):
            cells, place = np.divmod(cells, self.widths[i])
            out[:, i] = np.where(place == 0, np.nan, place)
        return out


def grid_of(points: DataFrame, names: Sequence[str]) -> Grid:
    parts = max(2, int(CELLS ** (1 / len(names))) - 1)
    chances = [i / parts for i in range(1, parts)]
    found = points.approxQuantile(list(names), chances, 0.01 / parts)
    return Grid([np.unique(e) for e in found])


class Cells:
    """What is known of the cells that hold points: their blocks and the corners of their points."""

    def __init__(self, rows: pd.DataFrame, names: Sequence[str]):
        self.cell = rows["cell"].to_numpy(np.int64)
        self.blocks = np.maximum(1, np.ceil(rows["n"].to_numpy() / BLOCK_ROWS)).astype(np.int64)
        self.low = rows[[f"low{n}" for n in names]].to_numpy(float)
        self.high = rows[[f"high{n}" for n in names]].to_numpy(float)
        self.targets = np.ones(len(rows), bool)
        self.rivals = np.ones(len(rows), bool)
        self.at = {c: i for i, c in enumerate(self.cell.tolist())}

    def decide(self, places: np.ndarray) -> None:
        """Cells that lie below another in all columns hold no result; if that knows the same columns,
        it also dominates whatever they do."""
        unknown = np.isnan(places)
        self.targets = ~beaten(places, places, False)
        for pattern in np.unique(unknown, axis=0):
            own = np.flatnonzero((unknown == pattern).all(axis=1))
            self.rivals[own] = ~beaten(places[own], places[own], False)


def _measured(rows: DataFrame, names: Sequence[str]) -> Cells:
    corners = [F.min(n).alias(f"low{n}") for n in names] + [F.max(n).alias(f"high{n}") for n in names]
    held = rows.groupBy("cell").agg(F.count("*").alias("n"), *corners)
    return Cells(held.orderBy("cell").toPandas(), names)  # at most CELLS rows


def _of_many(points: DataFrame, names: list[str], weak: bool) -> DataFrame:
    """The distinct points that no other dominates."""
    context = points.sparkSession.sparkContext
    points = checkpointed(points)
    grid = grid_of(points, names)
    schema = StructType([*points.schema, StructField("cell", LongType())])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch[names].to_numpy(float)
            keep = local_frontier(values, weak)
            yield batch[keep].assign(cell=grid.cells(values[keep]))

    rows = checkpointed(points.mapInPandas(place, schema))
    cells = _measured(rows, names)
    cells.decide(grid.places(cells.cell))
    given = context.broadcast(cells)
    blocked = StructType([*schema, StructField("block", IntegerType())])

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.array([given.value.at[c] for c in batch["cell"]], np.int64)
            keep = given.value.targets[at] | given.value.rivals[at]
            hashed = pd.util.hash_pandas_object(batch[names], index=False).to_numpy()
            block = (hashed % given.value.blocks[at].astype(np.uint64)).astype(np.int32)
            yield batch.assign(block=block)[keep]

    def thin(block: pd.DataFrame) -> pd.DataFrame:
        return block[local_frontier(block[names].to_numpy(float), weak)][[*names, "cell"]]

    rows = checkpointed(
        rows.mapInPandas(deal, blocked).groupBy("cell", "block").applyInPandas(thin, schema)
    )
    left = _measured(rows, names)
    known = np.array([cells.at[c] for c in left.cell.tolist()], np.int64)
    left.targets, left.rivals = cells.targets[known], cells.rivals[known]
    places = grid.places(left.cell)
    lost = _lost(rows, left, places, names, weak, schema)
    # Points of cells that lie below others altogether are no result either.
    out = context.broadcast(set(left.cell[~left.targets].tolist()))
    inside = F.udf(lambda c: c not in out.value, "boolean")
    open_rows = rows.filter(inside("cell")) if len(out.value) else rows
    same = reduce(and_, [open_rows[n].eqNullSafe(lost[n]) for n in names])
    return open_rows.join(lost, same, "left_anti").select(*names)


def _lost(rows, cells: Cells, places: np.ndarray, names, weak: bool, schema) -> DataFrame:
    """The distinct points that a point of their cell or of one that may dominate it beats."""
    given = rows.sparkSession.sparkContext.broadcast((cells, places))
    meeting = StructType(
        [*schema] + [StructField(n, LongType()) for n in ("other", "a", "b")]
    )

    def spread(as_rival: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held, where = given.value
            for batch in batches:
                values = batch[names].to_numpy(float)
                at = np.array([held.at[c] for c in batch["cell"]], np.int64)
                hashed = pd.util.hash_pandas_object(batch[names], index=False).to_numpy()
                own = (hashed % held.blocks[at].astype(np.uint64)).astype(np.int64)
                for cell in np.unique(at).tolist():
                    if not (held.rivals if as_rival else held.targets)[cell]:
                        continue
                    members = np.flatnonzero(at == cell)
                    mine = where[cell]
                    unknown = np.isnan(mine) | np.isnan(where)
                    if as_rival:
                        near = ((where <= mine) | unknown).all(axis=1) & held.targets
                    else:
                        near = ((where >= mine) | unknown).all(axis=1) & held.rivals
                    for other in np.flatnonzero(near & ~unknown.all(axis=1)).tolist():
                        corner = (held.low if as_rival else held.high)[other]
                        points = values[members]
                        less, more = (corner, points) if as_rival else (points, corner)
                        open_ = (more >= less) if weak else (more > less)
                        open_ |= np.isnan(points) | np.isnan(corner)
                        some = members[open_.all(axis=1)]
                        if not len(some):
                            continue
                        for block in range(int(held.blocks[other])):
                            part = batch.iloc[some]
                            sides = (block, own[some]) if as_rival else (own[some], block)
                            target, rival = (other, cell) if as_rival else (cell, other)
                            yield part.assign(
                                cell=held.cell[target], other=held.cell[rival], a=sides[0], b=sides[1]
                            )[meeting.names]

        return run

    def fight(targets: pd.DataFrame, rivals: pd.DataFrame) -> pd.DataFrame:
        if not len(targets) or not len(rivals):
            return targets[names].iloc[:0]
        worse = beaten(targets[names].to_numpy(float), rivals[names].to_numpy(float), weak)
        return targets[worse][names]

    key = ("cell", "other", "a", "b")
    sides = [rows.mapInPandas(spread(rival), meeting).groupBy(*key) for rival in (False, True)]
    points = StructType(schema.fields[: len(names)])
    return checkpointed(sides[0].cogroup(sides[1]).applyInPandas(fight, points).distinct())
