"""Periodic runs of words, by string synchronising sets.

A run is a stretch of words with smallest period q and at least 4 periods that no neighbouring word
extends. At scale t (4, 8, 16, ...) a synchronising set holds the positions i at which the smallest
hash of a window of t words, among those that start in i .. i+t, is that of the window at i or at
i+t. Whether i belongs to it depends on the 2t words from i on alone, so in a run of period q the set
repeats with q; and every stretch of 3t - 1 words holds a member in its first t, unless all of it has
a small period. Hence a run with t <= q < 2t holds two neighbouring members with equal contexts of
2t words that are q apart: such pairs propose periods, and comparing words decides how far they reach.

Windows of a period of at most t/4 are left out of the sets, whose members would crowd there. They
lie in runs that smaller scales have found; periods below 4 are found by comparing the words with
themselves 1, 2 and 3 places on.

Documents are taken many at a time: one array of word numbers holds a slice of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from lexiform.llm.batches import chunks_of_text, record_batch

PERIODS = 4  # that a run has at least
LENGTH = 6  # words that a run has at least
FIRST_SCALE = 4  # periods below are found directly
FAR = np.uint64(0xFFFFFFFFFFFFFFFF)

RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
RUNS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n_words", LongType()),
        StructField("runs", ArrayType(RUN)),
        StructField("strongest", RUN),
        StructField("collapsed", StringType()),
    ]
)


def words_of(text: str) -> list[bytes]:
    """Maximal stretches without blanks, tabs and line ends of ASCII."""
    return text.encode().split()


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ahead(x: np.ndarray, by: int, fill) -> np.ndarray:
    """x moved so that place i holds what was at i + by."""
    out = np.full_like(x, fill)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


def small_periods(words: np.ndarray, docs: np.ndarray) -> Iterator[tuple]:
    """(first word, word after the last, period) of stretches with periods below FIRST_SCALE."""
    for q in range(1, FIRST_SCALE):
        same = (words[q:] == words[:-q]) & (docs[q:] == docs[:-q])
        edges = np.flatnonzero(np.diff(same, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2] + q
        long = ends - starts >= PERIODS * q
        yield starts[long], ends[long], np.full(long.sum(), q)


def reach(words: np.ndarray, at: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The stretch around ``at``, between low and high, in which words equal those a period on."""
    end, step = at, 64
    while end + period < high:
        stop = min(end + step, high - period)
        differ = words[end:stop] != words[end + period : stop + period]
        first = int(differ.argmax())
        if differ[first]:
            end += first
            break
        end, step = stop, step * 2
    start, step = at, 64
    while start > low:
        stop = max(start - step, low)
        differ = (words[stop:start] != words[stop + period : start + period])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            start -= first
            break
        start, step = stop, step * 2
    return start, end + period


def synchronising(hashes: np.ndarray, scale: int, left: np.ndarray) -> np.ndarray:
    """The synchronising set of windows with these hashes; those out of reach hold FAR. ``left`` is
    the number of words from each place to the end of its document."""
    least, width = hashes, 1
    while width < scale:
        least = np.minimum(least, ahead(least, width, FAR))
        width *= 2
    last = ahead(hashes, scale, FAR)
    least = np.minimum(least, last)
    return np.flatnonzero(
        (left >= 2 * scale) & (least != FAR) & ((hashes == least) | (last == least))
    )


def find_runs(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows (document, first word in it, word after the last, period), sorted, of documents that
    stand one after the other in ``words``. Runs of a period of 1 have at least 4 words here."""
    lengths = np.asarray(lengths, np.int64)
    kept = np.flatnonzero(lengths >= PERIODS)
    docs = np.repeat(np.arange(len(lengths)), lengths)
    inside = lengths[docs] >= PERIODS
    words, docs = words[inside], docs[inside]
    found = np.zeros((0, 4), np.int64)
    if not len(words):
        return found

    def placed(first: np.ndarray) -> np.ndarray:
        """Where each document starts, by its number."""
        starts = np.zeros(len(lengths), np.int64)
        starts[kept] = first
        return starts

    def add(starts, ends, periods, own: np.ndarray) -> None:
        nonlocal found
        doc = docs[starts]
        new = np.stack([doc, starts - own[doc], ends - own[doc], periods], axis=1)
        found = np.concatenate([found, new])

    first = np.cumsum(lengths[kept]) - lengths[kept]
    own = placed(first)
    for starts, ends, periods in small_periods(words, docs):
        add(starts, ends, periods, own)

    # Hashes of windows of FIRST_SCALE words; those that run over an end are never used.
    hashes, scale = scrambled(words.astype(np.uint64) + np.uint64(1)), 1
    while True:
        if scale >= FIRST_SCALE:
            long = lengths[docs] >= PERIODS * scale
            if not long.all():
                words, docs, hashes = words[long], docs[long], hashes[long]
                kept = kept[lengths[kept] >= PERIODS * scale]
                own = placed(np.cumsum(lengths[kept]) - lengths[kept])
            if not len(words):
                break
        wider = scrambled(hashes * np.uint64(0x9E3779B97F4A7C15) + ahead(hashes, scale, 0))
        if scale >= FIRST_SCALE:
            ends = own + lengths
            left = ends[docs] - np.arange(len(words))
            usable = left >= scale
            known = found[
                (PERIODS * found[:, 3] <= scale)
                & (found[:, 2] - found[:, 1] >= scale)
                & (lengths[found[:, 0]] >= PERIODS * scale)
            ]
            if len(known):
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, own[known[:, 0]] + known[:, 1], 1)
                np.add.at(cover, own[known[:, 0]] + known[:, 2] - scale + 1, -1)
                usable &= np.cumsum(cover[:-1]) == 0
            members = synchronising(np.where(usable, hashes, FAR), scale, left)
            add(*_decided(words, members, wider, docs, own, ends, scale), own)
        hashes, scale = wider, scale * 2
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    # A stretch that has several periods was found with the smallest as well.
    again = np.zeros(len(found), bool)
    again[1:] = (found[1:, :3] == found[:-1, :3]).all(1)
    found = found[~again]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _decided(words, members, contexts, docs, own, ends, scale) -> tuple:
    """The runs among what neighbouring members with equal contexts propose."""
    context = scrambled(contexts[members] ^ scrambled(docs[members].astype(np.uint64)))
    order = np.argsort(context, kind="stable")
    at, context = members[order], context[order]
    apart = np.diff(at)
    near = (context[1:] == context[:-1]) & (apart >= scale) & (apart < 2 * scale)
    at, apart = at[:-1][near], apart[near]
    order = np.lexsort((at, apart))
    runs, last = [], (0, 0)
    for place, period in zip(at[order].tolist(), apart[order].tolist()):
        if period == last[0] and place + period < last[1]:
            continue
        doc = docs[place]
        start, end = reach(words, place, period, int(own[doc]), int(ends[doc]))
        if end - start >= PERIODS * period:
            runs.append((start, end, period))
        last = (period, end)
    return tuple(np.array(runs, np.int64).reshape(-1, 3).T)


def _stronger(a: tuple[int, int, int], b: tuple[int, int, int]) -> int:
    """Order by exponent, the greatest first, then by start and period."""
    x, y = a[1] * b[2], b[1] * a[2]
    return -1 if x > y else 1 if x < y else -1 if (a[0], a[2]) < (b[0], b[2]) else 1


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by blanks."""
    if runs:
        edges = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edges[start + period] += 1
            edges[start + length] -= 1
        words = compress(words, (np.cumsum(edges[:-1]) == 0).tolist())
    return b" ".join(words)


def periodic_runs(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_words, runs, strongest, collapsed.

    ``runs`` holds start (word number), length and period in words of every run with at least 4
    periods and 6 words, by start and then period; ``strongest`` is that of the greatest length to
    period, then the smallest start and period, null without runs. ``collapsed`` is the text with one
    period left of each run, words joined by one blank. A null or empty text has no words. Every row
    is judged by itself, repeated and null keys included; an empty table gives none. Other columns
    are not read. Texts are compared word by word; the hashes of 64 bits only propose.
    """

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks_of_text(batches, "text"):
            split = [words_of(t) for t in texts]
            numbers: dict[bytes, int] = {}
            lengths = np.array([len(ws) for ws in split], np.int64)
            codes = np.fromiter(
                (numbers.setdefault(w, len(numbers)) for ws in split for w in ws),
                np.int64,
                int(lengths.sum()),
            )
            runs: list[list] = [[] for _ in split]
            for doc, start, end, period in find_runs(codes, lengths).tolist():
                if end - start >= LENGTH:
                    runs[doc].append((start, end - start, period))
            strongest = [min(r, key=cmp_to_key(_stronger), default=None) for r in runs]
            yield record_batch(
                RUNS,
                {
                    "doc_id": part.column("key"),
                    "n_words": lengths,
                    "runs": [[dict(zip(RUN.names, r)) for r in rs] for rs in runs],
                    "strongest": [r and dict(zip(RUN.names, r)) for r in strongest],
                    "collapsed": pa.array(
                        [collapsed(ws, rs) for ws, rs in zip(split, runs)], pa.binary()
                    ).cast(pa.string()),
                },
            )

    rows = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(detect, RUNS).withColumnRenamed("doc_id", key)


def written(runs: str) -> Column:
    """All runs as lines ``start,length,period``."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))))
