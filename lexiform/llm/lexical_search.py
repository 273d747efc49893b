"""Ranked lexical search over an inverted index, by a hybrid of terms and documents at a time.

The index is cut by documents into segments of bounded size; a row is a term's list in a segment, or
(with a null term) the segment's documents. A search visits every segment by itself. There the short
lists of a query are summed term at a time into accumulators. The accumulators then are one more
iterator with a known bound, beside the long lists, and all of them are traversed document at a time:
ranges of documents whose bounds cannot reach the query's k-th score are skipped, and in the others
only documents of the lists that matter are looked up in the rest. A task carries the k best of each
query from segment to segment, so bounds bite the sooner the more it has seen.

Scores are whole numbers of 64 bits. With N documents that hold a term, L terms in them, n in one
document, df documents that hold the term and tf occurrences: weight w = floor(1000 * ln((2N + 2) /
(2df + 1))), m = 75 + 25nN div L, and a document scores the sum of w * (10^9 tf div (1000tf + 12m)).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from lexiform.cluster import fresh_path
from lexiform.llm.batches import chunks_of_text, record_batch

SEGMENT_DOCS = 8_192
SEGMENT_TERMS = 4_000_000
RANGE = 512  # documents that are skipped or visited together
SHORT = 32  # a list is short if it holds at most this part of a segment's documents
PIECE_BYTES = 4_000_000  # of a long text that are cut into terms at a time
BLOCK_TERMS = 500_000  # terms of queries that are held at a time, on the driver and in tasks
BROADCAST_BYTES = 16_000_000

# Bytes of terms, A-Z in lower case; all else is a blank.
FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
    else 0x20
    for b in range(256)
)

INDEX = StructType(
    [
        StructField("segment", LongType()),
        StructField("term", StringType()),
        StructField("n", LongType()),
        StructField("total", LongType()),
        StructField("ids", ArrayType(LongType())),
        StructField("places", BinaryType()),
        StructField("counts", BinaryType()),
    ]
)


def term_lists(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    data = text.encode().translate(FOLDED)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE_BYTES)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


class Numbers(dict):
    """Numbers keys in the order of their first use."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class Segment:
    """Collects documents and gives the rows of their part of the index."""

    def __init__(self, number: int):
        self.number, self.terms = number, Numbers()
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.codes: list[np.ndarray] = []
        self.total = 0

    @property
    def full(self) -> bool:
        return len(self.ids) >= SEGMENT_DOCS or self.total >= SEGMENT_TERMS

    def add(self, identifier: int | None, text: str) -> None:
        n = 0
        for terms in term_lists(text):
            self.codes.append(
                np.fromiter(map(self.terms.__getitem__, terms), np.int32, len(terms))
            )
            n += len(terms)
        if n:
            self.ids.append(identifier)
            self.lengths.append(n)
            self.total += n

    def rows(self) -> pa.RecordBatch:
        docs = len(self.ids)
        owner = np.repeat(np.arange(docs, dtype=np.int64), self.lengths)
        key = np.concatenate(self.codes).astype(np.int64) * docs + owner
        key, counts = np.unique(key, return_counts=True)
        term, place = np.divmod(key, docs)
        starts = np.flatnonzero(np.diff(term, prepend=-1))
        sizes = np.diff(starts, append=len(term))
        n_terms = len(sizes)

        def lists(values: np.ndarray, own: bytes) -> pa.Array:
            width = values.itemsize
            ends = np.concatenate([[0], np.cumsum(sizes * width), [0]]).astype(np.int64)
            ends[-1] = ends[-2] + len(own)
            data = values.tobytes() + own
            return pa.Array.from_buffers(
                pa.large_binary(), n_terms + 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]
            ).cast(pa.binary())

        held = [None] * (n_terms + 1)
        held[-1] = self.ids
        names = pa.array([*self.terms, None], pa.binary())
        batch = record_batch(
            INDEX,
            {
                "segment": np.full(n_terms + 1, self.number),
                "term": names.cast(pa.string()),
                "n": np.append(sizes, docs),
                "total": np.append(np.add.reduceat(counts, starts), self.total),
                "ids": held,
                "places": lists(place.astype("<u2" if docs <= 65_536 else "<u4"), b""),
                "counts": lists(
                    counts.astype("<u4"), np.asarray(self.lengths, "<i8").tobytes()
                ),
            },
        )
        return batch.sort_by("term")


def build_index(
    documents: DataFrame, folder: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The index of all documents, written to ``folder``.

    Terms are what is left between ASCII characters other than letters and digits, A-Z lower-cased;
    a null or empty text has none and takes no part. Every row is a document of its own, repeated
    and null keys included. An empty table gives an empty index; other columns are not read.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        segment = Segment(first)
        for part, texts in chunks_of_text(batches, "text"):
            for identifier, words in zip(part.column("key").to_pylist(), texts):
                segment.add(identifier, words)
                if segment.full:
                    yield segment.rows()
                    segment = Segment(segment.number + 1)
        if segment.ids:
            yield segment.rows()

    rows = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    rows.mapInArrow(build, INDEX).write.parquet(folder)
    return documents.sparkSession.read.schema(INDEX).parquet(folder)


class Lists:
    """A term's list in a segment, ready to be traversed: places, scores and their bounds."""

    def __init__(self, places: np.ndarray, scores: np.ndarray, n_ranges: int):
        self.places, self.scores = places, scores
        self.starts = np.searchsorted(places, np.arange(n_ranges + 1) * RANGE)
        self.bounds = np.zeros(n_ranges, np.int64)
        some = np.flatnonzero(np.diff(self.starts))
        if len(some):
            self.bounds[some] = np.maximum.reduceat(scores, self.starts[some])
        self.bound = int(self.bounds.max(initial=0))


class Best:
    """The k best documents of a query so far: by score, then key, null keys last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = self.ids = np.zeros(0, np.int64)
        self.nulls = np.zeros(0, bool)

    @property
    def least(self) -> int:
        """What a document must score to be worth a look."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, nulls = np.concatenate([self.ids, ids]), np.concatenate([self.nulls, nulls])
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]


def accumulated(lists: list[tuple[Lists, int]], n_ranges: int) -> Lists:
    """The sum of lists, each so many times, as one list."""
    places = np.concatenate([a.places for a, _ in lists])
    scores = np.concatenate([a.scores * times for a, times in lists])
    held, at = np.unique(places, return_inverse=True)
    sums = np.zeros(len(held), np.int64)
    np.add.at(sums, at, scores)
    return Lists(held, sums, n_ranges)


def traverse(lists: list[tuple[Lists, int]], docs: int, best: Best, ids, nulls) -> None:
    """Bring the documents of a segment that belong to the k best of a query to ``best``."""
    n_ranges = -(-docs // RANGE)
    if sum(a.bound * times for a, times in lists) < best.least:
        return
    short = [x for x in lists if len(x[0].places) * SHORT <= docs]
    if len(short) > 1:
        lists = [x for x in lists if len(x[0].places) * SHORT > docs]
        lists.append((accumulated(short, n_ranges), 1))
    bounds = np.stack([a.bounds * times for a, times in lists])
    reach = bounds.sum(0)
    for r in np.flatnonzero(reach >= best.least).tolist():
        least = best.least
        if reach[r] < least:
            continue
        order = np.argsort(bounds[:, r], kind="stable")
        below = np.cumsum(bounds[order, r])  # what a list and all lesser ones can add
        rest = int(np.searchsorted(below, least))  # these alone cannot reach it
        sums = np.zeros(RANGE, np.int64)
        for i in order[rest:].tolist():
            a, times = lists[i]
            part = slice(a.starts[r], a.starts[r + 1])
            sums[a.places[part] - r * RANGE] += a.scores[part] * times
        alive = np.flatnonzero(sums)
        for j in range(rest - 1, -1, -1):
            alive = alive[sums[alive] + below[j] >= least]
            if not len(alive):
                break
            a, times = lists[order[j]]
            held = a.places[a.starts[r] : a.starts[r + 1]]
            if len(held):
                at = np.searchsorted(held, alive + r * RANGE)
                at[at == len(held)] = 0
                hit = held[at] == alive + r * RANGE
                sums[alive[hit]] += a.scores[a.starts[r] + at[hit]] * times
        alive = alive[sums[alive] >= least]
        if len(alive):
            places = alive + r * RANGE
            best.add(sums[alive], ids[places], nulls[places])


class Searcher:
    """Queries of a block against one segment after the other."""

    def __init__(self, asked: list, n_docs: int, n_terms: int, k: int):
        self.terms, self.weights = Numbers(), []
        self.queries: dict[int, list[tuple[int, int]]] = {}
        self.keys: dict[int, int | None] = {}
        for query, key, term, times, weight in asked:
            number = self.terms[term]
            if number == len(self.weights):
                self.weights.append(weight)
            self.queries.setdefault(query, []).append((number, times))
            self.keys[query] = key
        self.n_docs, self.n_terms, self.k = n_docs, n_terms, k

    def start(self) -> dict[int, Best]:
        return {q: Best(self.k) for q in self.queries}

    def visit(self, rows: list[dict], best: dict[int, Best]) -> None:
        own = next(r for r in rows if r["term"] is None)
        docs = own["n"]
        nulls = np.array([i is None for i in own["ids"]])
        ids = np.array([i or 0 for i in own["ids"]], np.int64)
        m = 75 + 25 * self.n_docs * np.frombuffer(own["counts"], "<i8") // self.n_terms
        held = {}
        for row in rows:
            if row["term"] is not None:
                number = self.terms[row["term"]]
                width = len(row["places"]) // row["n"]
                places = np.frombuffer(row["places"], f"<u{width}").astype(np.int64)
                tf = np.frombuffer(row["counts"], "<u4").astype(np.int64)
                scores = self.weights[number] * (
                    1_000_000_000 * tf // (1000 * tf + 12 * m[places])
                )
                held[number] = Lists(places, scores, -(-docs // RANGE))
        for query, terms in self.queries.items():
            lists = [(held[t], times) for t, times in terms if t in held]
            if lists:
                traverse(lists, docs, best[query], ids, nulls)


FOUND = StructType(
    [
        StructField("query", LongType()),
        StructField("key", LongType()),
        StructField("doc_id", LongType()),
        StructField("score", LongType()),
    ]
)


def search(
    index: DataFrame, items: DataFrame, k: int = 20, key: str = "item_id", text: str = "text"
) -> DataFrame:
    """For each item its ``k`` highest-scoring documents: key, rank from 1, doc_id, score above 0.

    Equal scores are ranked by doc_id, null doc_ids last and several of one id in any order. Items
    have terms like documents, repeats count; items without any (null texts too) find nothing. Every
    row is an item of its own, so a repeated key has its ranks repeatedly. Empty tables find nothing.
    """
    spark = index.sparkSession
    asked_schema = "query bigint, key bigint, term string, times bigint"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = TaskContext.get().partitionId() << 32
        for part, texts in chunks_of_text(batches, "text"):
            for identifier, words in zip(part.column("key").to_pylist(), texts):
                counts: dict[bytes, int] = {}
                for terms in term_lists(words):
                    for term in terms:
                        counts[term] = counts.get(term, 0) + 1
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([query] * n, pa.int64()),
                        pa.array([identifier] * n, pa.int64()),
                        pa.array([*counts], pa.binary()).cast(pa.string()),
                        pa.array([*counts.values()], pa.int64()),
                    ],
                    names=["query", "key", "term", "times"],
                )
                query += 1

    folder = fresh_path(spark, "asked")
    items.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).mapInArrow(
        ask, asked_schema
    ).write.parquet(folder)
    asked = spark.read.schema(asked_schema).parquet(folder)
    totals = index.filter("term IS NULL").agg(F.sum("n"), F.sum("total")).first()
    n_asked = asked.count()
    if not n_asked or not totals[0]:
        return _ranked(spark.createDataFrame([], FOUND), k, key)

    words = asked.select("term").distinct()
    weight = F.floor(1000 * F.log((2 * F.lit(totals[0]) + 2) / (2 * F.col("df") + 1)))
    weights = (
        _lists(index, words).groupBy("term").agg(F.sum("n").alias("df"))
        .select("term", weight.alias("weight"))
    )
    folder = fresh_path(spark, "weights")
    asked.join(weights, "term").write.parquet(folder)
    weighted = spark.read.parquet(folder)

    found = fresh_path(spark, "found")
    blocks = math.ceil(n_asked / BLOCK_TERMS)
    for block in range(blocks):
        part = weighted.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)
        rows = part.select("query", "key", "term", "times", "weight").orderBy("query", "term")
        held = spark.sparkContext.broadcast(
            Searcher([tuple(r) for r in rows.collect()], totals[0], totals[1], k)
        )
        lists = _lists(index, part.select("term").distinct())
        (
            lists.unionByName(index.filter("term IS NULL"))
            .repartition("segment")
            .sortWithinPartitions("segment")
            .mapInArrow(_searching(held), FOUND)
            .write.mode("append").parquet(found)
        )
        held.unpersist()
    return _ranked(spark.read.schema(FOUND).parquet(found), k, key)


def _lists(index: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of the index with these terms."""
    n_bytes = words.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    words = F.broadcast(words) if n_bytes <= BROADCAST_BYTES else words
    return index.filter("term IS NOT NULL").join(words, "term", "left_semi").select(index.columns)


def _searching(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = held.value
        best, rows = searcher.start(), []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and rows[0]["segment"] != row["segment"]:
                    searcher.visit(rows, best)
                    rows = []
                rows.append(row)
        if rows:
            searcher.visit(rows, best)
        for query, top in best.items():
            n = len(top.scores)
            if n:
                yield record_batch(
                    FOUND,
                    {
                        "query": [query] * n,
                        "key": [searcher.keys[query]] * n,
                        "doc_id": pa.array(top.ids, mask=top.nulls),
                        "score": top.scores,
                    },
                )

    return run


def _ranked(found: DataFrame, k: int, key: str) -> DataFrame:
    order = Window.partitionBy("query").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id")
    )
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select(F.col("key").alias(key), "rank", "doc_id", "score")
    )
