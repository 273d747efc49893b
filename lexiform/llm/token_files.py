"""Token ids in binary files: document boundaries are Elias-Fano coded, with select structures.

A file is one segment: a header, the ends of its documents as an Elias-Fano sequence over the number
of its ids, the document ids as another over their range, then all ids as one array of 2- or 4-byte
integers. A boundary costs about 2 + log2(mean length) bits. ``select`` finds the i-th boundary by a
sampled position and a short scan of the upper bits, so no table of 64-bit offsets exists anywhere.

Files are written and read through Spark's own writers and readers, so any file system that Spark
knows will do. The text writer ends a record with a newline: the last byte of every file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from lexiform.cluster import fresh_path
from lexiform.llm.batches import chunks_of_text, record_batch
from lexiform.llm.forced_boundary import codec_of, shared_vocabulary

MAGIC = b"TOKSEG1\n"
# magic, task, segment, documents, documents without an id, ids, width, smallest document id
HEADER = "<8sqqqqqqq"
HEADER_BYTES = struct.calcsize(HEADER)
SEGMENT_IDS = 4_000_000  # ids after which a file ends
ROWS = 10_000  # documents that are read at a time
SAMPLED = 256  # every so many set bits, their position is kept


class EliasFano:
    """A non-decreasing sequence of n integers in [0, u]."""

    FRAME = "<QQBQQQ"  # n, u, low bits, bytes of low, high and samples

    def __init__(self, n, u, low_bits, low, high, samples):
        self.n, self.u, self.low_bits = n, u, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, u = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (u // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        bits = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        upper = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        upper[places] = 1
        return cls(
            n, u, low_bits,
            np.packbits(bits.ravel(), bitorder="little"),
            np.packbits(upper, bitorder="little"),
            places[::SAMPLED].astype("<u4"),
        )

    def to_bytes(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]
        return struct.pack(self.FRAME, self.n, self.u, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def read(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        n, u, low_bits, *sizes = struct.unpack_from(cls.FRAME, data, at)
        at += struct.calcsize(cls.FRAME)
        parts = []
        for size, kind in zip(sizes, (np.uint8, np.uint8, "<u4")):
            parts.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
            at += size
        return cls(n, u, low_bits, *parts), at

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sample on."""
        place = int(self.samples[i // SAMPLED])
        left, byte = i % SAMPLED, place >> 3
        word = int(self.high[byte]) >> (place & 7) << (place & 7)
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        place = 8 * byte + (word & -word).bit_length() - 1
        start, low = i * self.low_bits, 0
        for b in range(self.low_bits):
            bit = start + b
            low |= (int(self.low[bit >> 3]) >> (bit & 7) & 1) << b
        return (place - i) << self.low_bits | low

    def values(self) -> np.ndarray:
        """All values at once."""
        if not self.n:
            return np.zeros(0, np.int64)
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        low = bits.reshape(self.n, self.low_bits).astype(np.uint64) @ weights
        return (high | low.astype(np.uint64)).astype(np.int64)


def segment_bytes(task: int, number: int, keys: list, ids: list[bytes], width: int) -> bytes:
    """One file: documents in order, those without an id first; ids as ``width``-byte integers."""
    present = np.array([k for k in keys if k is not None], np.int64)
    least = int(present.min()) if len(present) else 0
    ends = np.cumsum([len(i) // width for i in ids])
    body = b"".join(ids)
    return b"".join(
        [
            struct.pack(
                HEADER, MAGIC, task, number, len(keys), len(keys) - len(present),
                len(body) // width, width, least
            ),
            EliasFano.of(ends).to_bytes(),
            EliasFano.of((present - least).astype(np.uint64)).to_bytes(),
            body,
        ]
    )


class Segment:
    """A file's documents: ``ids(i)`` finds one by select."""

    def __init__(self, data: bytes):
        (magic, self.task, self.number, self.n, self.n_null, self.n_ids, self.width, least) = (
            struct.unpack_from(HEADER, data)
        )
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        self.ends, at = EliasFano.read(data, HEADER_BYTES)
        keys, at = EliasFano.read(data, at)
        self.keys = [None] * self.n_null + (keys.values() + least).tolist()
        self.array = np.frombuffer(data, f"<u{self.width}", self.n_ids, at)

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return self.array[start:end]


def write_tokens(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Write the ids of all documents, each followed by ``end_id``, in ascending order of an integer key.

    A null text is empty. Null keys come first; rows that share a key stay in the order of their
    scan, and may be spread over several files. An empty table gives no segments.
    """
    vocabulary = shared_vocabulary(docs, path)
    rows = docs.select(
        docs[key].cast("bigint").alias("key"), F.monotonically_increasing_id().alias("turn"),
        docs[text].alias("text"),
    )
    coded = StructType(
        [
            StructField("key", LongType()),
            StructField("turn", LongType()),
            StructField("width", IntegerType()),
            StructField("size", LongType()),
            StructField("ids", BinaryType()),
        ]
    )
    schema = StructType([StructField("content", BinaryType())])
    end = np.asarray([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary.value)
        width = 2 if max(len(codec.tokens) - 1, end_id) < 1 << 16 else 4
        for part, texts in chunks_of_text(batches):
            ids = [np.frombuffer(i + end, "<u4").astype(f"<u{width}") for i in codec.encode(texts)]
            columns = {n: part.column(n) for n in ("key", "turn")}
            # Compressed, as they are written and shuffled once more.
            packed = [pa.compress(i.tobytes(), "zstd", asbytes=True) for i in ids]
            columns |= {"width": [width] * len(ids), "size": [i.nbytes for i in ids], "ids": packed}
            yield record_batch(coded, columns)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, keys, ids, size, width = TaskContext.get().partitionId(), 0, [], [], 0, 4
        for batch in batches:
            for key, width, n_bytes, data in zip(*(c.to_pylist() for c in batch.columns)):
                keys.append(key)
                ids.append(pa.decompress(data, n_bytes, "zstd", asbytes=True))
                size += n_bytes // width
                if size >= segment_ids:
                    content = segment_bytes(task, number, keys, ids, width)
                    yield record_batch(schema, {"content": [content]})
                    number, keys, ids, size = number + 1, [], [], 0
        if keys:
            content = segment_bytes(task, number, keys, ids, width)
            yield record_batch(schema, {"content": [content]})

    # Texts stay in place; only their ids are sorted.
    spark, ready = docs.sparkSession, fresh_path(docs.sparkSession, "ids")
    rows.mapInArrow(encode, coded).write.parquet(ready)
    ordered = spark.read.schema(coded).parquet(ready)
    ordered = ordered.repartitionByRange("key", "turn").sortWithinPartitions("key", "turn")
    segments = ordered.select("key", "width", "size", "ids").mapInArrow(write, schema)
    segments.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(
        folder
    )


def read_tokens(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files: key, start (ids of all before it), n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").load(folder).filter(F.col("length") > HEADER_BYTES)
    schema = StructType(
        [
            StructField(n, LongType())
            for n in ("task", "number", "key", "within", "n_tokens", "ids_crc32")
        ]
    )
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                segment = Segment(content.as_buffer())
                for first in range(0, segment.n, ROWS):
                    yield documents(segment, first, min(first + ROWS, segment.n))

    def documents(segment: Segment, first: int, last: int) -> pa.RecordBatch:
        start, starts, sizes, sums = segment.bounds(first)[0], [], [], []
        for i in range(first, last):
            end = segment.ends.select(i)
            starts.append(start)
            sizes.append(end - start)
            sums.append(zlib.crc32(segment.array[start:end].astype("<u4")))
            start = end
        return record_batch(
            schema,
            {
                "task": [segment.task] * len(starts),
                "number": [segment.number] * len(starts),
                "key": segment.keys[first:last],
                "within": starts,
                "n_tokens": sizes,
                "ids_crc32": sums,
            },
        )

    # Files are read once; a row per file says how many ids are before it.
    found = fresh_path(spark, "found")
    files.select("content").mapInArrow(read, schema).write.parquet(found)
    docs = spark.read.schema(schema).parquet(found)
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    sizes = docs.groupBy("task", "number").agg(F.sum("n_tokens").alias("n_ids"))
    bases = sizes.select(
        "task", "number", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")
    )
    return docs.join(bases, ["task", "number"]).select(
        F.col("key").alias(key), (F.col("base") + F.col("within")).alias("start"), "n_tokens",
        "ids_crc32",
    )
