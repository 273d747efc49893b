"""Pack token sequences into bins by hierarchical residual best fit.

Each task cuts its documents into pieces, best-fits the pieces (largest first) into bins and emits
the bins that are nearly full. Underfull bins become items of the next round: fewer tasks merge the
bins of several and best-fit them again, until one task holds what is left. Only underfull bins are
shuffled, as lengths and checksums; the ids themselves never leave the task that made them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from lexiform.cluster import fresh_path
from lexiform.llm.batches import chunks_of_text
from lexiform.llm.forced_boundary import codec_of, shared_vocabulary

CAPACITY = 2048
NEARLY_FULL = 0.996  # a bin filled to this share is emitted before the last round
BINS_PER_TASK = 50_000  # underfull bins that one task merges; a task of texts flushes as often
FAN_IN = 8  # tasks whose underfull bins meet in the next round

PIECE = [
    ("doc_id", LongType()),
    ("piece", IntegerType()),
    ("start", LongType()),
    ("length", LongType()),
    ("ids_crc32", LongType()),
    ("offset", LongType()),
]


def bins_schema(id_type) -> StructType:
    piece = StructType([StructField(n, id_type if n == "doc_id" else t) for n, t in PIECE])
    return StructType(
        [
            StructField("sequence_id", LongType()),
            StructField("fill", IntegerType()),
            StructField("done", BooleanType()),
            StructField("pieces", ArrayType(piece)),
        ]
    )


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Items by bin: largest first, each into the fullest open bin that can take it."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by what still fits
    mask = 0  # bit r is set if a bin has room for exactly r
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        above = mask >> size
        if above and size:
            left = size + (above & -above).bit_length() - 1
            number = room[left].pop()
            if not room[left]:
                mask &= ~(1 << left)
        else:
            left, number = capacity, len(bins)
            bins.append([])
        bins[number].append(item)
        left -= size
        if left:
            room[left].append(number)
            mask |= 1 << left
    return bins


def cut_points(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only the first may be shorter than the capacity."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


class BinWriter:
    """Numbers bins uniquely over rounds, tasks and flushes, and makes batches of them."""

    def __init__(self, round_number: int, schema: pa.Schema):
        self.next = (round_number << 56) | (TaskContext.get().partitionId() << 28)
        self.schema = schema

    def batch(self, bins: list[tuple[int, bool, list]]) -> pa.RecordBatch:
        ids = range(self.next, self.next + len(bins))
        self.next += len(bins)
        columns = [list(ids), *map(list, zip(*bins))]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema
        )


def _packed(items: list[tuple[int, list]], capacity: int, emit_at: float, last: bool) -> list:
    sizes = np.array([i[0] for i in items], dtype=np.int64)
    made = []
    for members in best_fit(sizes, capacity):
        fill = int(sizes[members].sum())
        pieces, place = [], 0
        for member in members:
            for piece in items[member][1]:
                pieces.append((*piece[:5], place))
                place += piece[3]
        made.append((fill, last or fill >= emit_at, pieces))
    return made


def pack_documents(
    docs: DataFrame,
    path: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    nearly_full: float = NEARLY_FULL,
    bins_per_task: int = BINS_PER_TASK,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its whole text and ``end_id``; a null text is empty and so has one id.
    Documents longer than ``capacity`` are cut into pieces of that size, the first of which may be
    shorter. Repeated rows and null keys are packed as documents of their own. An empty table gives
    an empty result. Other columns are not read.
    """
    vocabulary = shared_vocabulary(docs, path)
    rows = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"))
    schema = bins_schema(rows.schema["doc_id"].dataType)
    arrow = to_arrow_schema(schema)
    emit_at = min(capacity, math.ceil(capacity * nearly_full))
    end = np.asarray([end_id], "<u4").tobytes()

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, writer = codec_of(vocabulary.value), BinWriter(0, arrow)
        items: list[tuple[int, list]] = []
        for part, texts in chunks_of_text(batches):
            full = []
            keys = part.column("doc_id").to_pylist()
            for doc, ids in zip(keys, codec.encode(texts)):
                ids += end
                for number, (start, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    piece = (doc, number, start, length, crc, 0)
                    if length == capacity:
                        full.append((length, True, [piece]))
                    else:
                        items.append((length, [piece]))
            if full:
                yield writer.batch(full)
            if len(items) >= bins_per_task:
                yield writer.batch(_packed(items, capacity, emit_at, False))
                items = []
        if items:
            yield writer.batch(_packed(items, capacity, emit_at, False))

    def merge(number: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            writer, items = BinWriter(number, arrow), []
            names = [n for n, _ in PIECE]
            for batch in batches:
                for fill, pieces in zip(
                    batch.column("fill").to_pylist(), batch.column("pieces").to_pylist()
                ):
                    items.append((fill, [tuple(p[n] for n in names) for p in pieces]))
                if len(items) >= 2 * bins_per_task:
                    yield writer.batch(_packed(items, capacity, emit_at, last))
                    items = []
            if items:
                yield writer.batch(_packed(items, capacity, emit_at, last))

        return run

    spark = docs.sparkSession

    def written(bins: DataFrame) -> DataFrame:
        folder = fresh_path(spark, "bins")
        bins.write.parquet(folder)
        return spark.read.schema(schema).parquet(folder)

    made = written(rows.mapInArrow(first_round, schema))
    finished = made.filter("done")
    open_bins = made.filter("NOT done")
    count, number, tasks = open_bins.count(), 1, None
    while count:
        needed = math.ceil(count / bins_per_task)
        tasks = needed if tasks is None else max(needed, math.ceil(tasks / FAN_IN))
        spread = open_bins.repartition(tasks, F.pmod(F.xxhash64("sequence_id"), F.lit(tasks)))
        last = tasks == 1
        made = written(spread.mapInArrow(merge(number, last), schema))
        finished = finished.unionByName(made.filter("done"))
        open_bins = made.filter("NOT done")
        before, count = count, open_bins.count()
        number += 1
        if count and count > 0.98 * before:  # what is left does not fit together
            finished = finished.unionByName(open_bins)
            break
    return finished.select("sequence_id", F.explode("pieces").alias("p")).select(
        *(f"p.{n}" for n, _ in PIECE), "sequence_id"
    )
