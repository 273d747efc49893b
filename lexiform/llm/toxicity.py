"""Toxicity by two class-conditional Kneser-Ney models that share their lowest order.

Word pairs and words are counted in a toxic and an ordinary sample. Each class smooths its pairs by
its own word model, whose counts are numbers of distinct words in front (so that copies of a text add
nothing), and that by shared continuation counts: in how many different surroundings a word occurs
in the whole corpus. A rare expression that only one class has seen is therefore weighed against how
freely it occurs anywhere.

A document is compared by length-normalised log-likelihoods: over the whole text, over its most
toxic window of a few words and over its most toxic word, as a long text dilutes a short insult. A
ratio that rests on few sightings counts less. A logistic model over the three, fitted on labelled
documents that were not counted, turns them into a probability.

The model holds every word and word pair of the two samples. Others need no entry: a word or pair that
neither class has seen rests on no sightings, so its own ratio is 0 and it backs off entirely. Of the
corpus every word and pair counts; the counts stay a table, of which the words of the samples and the
total of all others are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from lexiform.cluster import fresh_path
from lexiform.llm.batches import chunks_of_text, record_batch, remainder
from lexiform.llm.pairwise_rank import logistic

SAMPLE = 8_000  # ordinary documents that the fit takes, by hash; half as many toxic ones
DISCOUNT = 0.75
WINDOW = 3
SIGHTINGS = 5  # surroundings in which a word was seen when its ratio counts half
PAIR_SIGHTINGS = 200  # the same for a word pair
RATIOS = ("mean_ratio", "peak_ratio", "window_ratio")
THRESHOLD = 0.3
PAIRS_IN_TASK = 500_000  # distinct pairs that a task holds before it emits them
PAIRS_AT_ONCE = 500_000  # pairs of the model that the driver works on at a time
PARTS = 4  # parts of the corpus' pairs per shuffle partition
WORD = re.compile(r"[^\W_]+")

UNKNOWN, START = 0, 1  # words are numbered from 2
BASE = 1 << 31  # more than there are numbers
HASHED = 1 << 62  # least identifier of a word without a number


def trust(sightings: np.ndarray, half: int = SIGHTINGS) -> np.ndarray:
    """How far a ratio counts that rests on so many sightings in the two samples."""
    return sightings / (sightings + half)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


@lru_cache(maxsize=2)
def numbers_of(words: bytes) -> dict[str, int]:
    """The number of each word, from all words joined by line ends; a worker keeps it."""
    return {w: i + 2 for i, w in enumerate(words.decode().split("\n"))} if words else {}


def numbered(texts: list[str], ids: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, each after a START, and the positions of the STARTs."""
    lists = [words_of(t) for t in texts]
    lengths = np.array([len(w) + 1 for w in lists], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    out = np.empty(int(lengths.sum()), np.int64)
    inside = np.ones(len(out), bool)
    inside[starts] = False
    out[starts] = START
    out[inside] = np.fromiter(
        (ids.get(w, UNKNOWN) for ws in lists for w in ws), np.int64, int(inside.sum())
    )
    return out, starts


def pair_keys(numbers: np.ndarray) -> np.ndarray:
    """(word before, word) as one integer for every position but the STARTs."""
    keys = numbers[:-1] * BASE + numbers[1:]
    return keys[numbers[1:] != START]


def identified(texts: list[str], ids: dict[str, int]) -> np.ndarray:
    """Like numbered, but a word without a number is known by a hash of its own."""
    numbers, _ = numbered(texts, ids)
    missing = np.flatnonzero(numbers == UNKNOWN)
    if len(missing):
        words = np.array([w for t in texts for w in words_of(t) if w not in ids], dtype=object)
        hashes = pd.util.hash_array(words, categorize=True) >> np.uint64(2)
        numbers[missing] = hashes.astype(np.int64) + HASHED
    return numbers


@dataclass
class ClassCounts:
    """What one class has seen: by word the different words in front of it, by word in front its
    followers and their kinds, and its pairs."""

    contexts: np.ndarray
    after: np.ndarray
    kinds: np.ndarray
    pairs: np.ndarray  # sorted
    counts: np.ndarray


@dataclass
class KneserNey:
    """Log-likelihood ratios of the toxic over the ordinary class."""

    pairs: np.ndarray  # sorted keys of pairs that a class has seen
    pair_ratio: np.ndarray
    before_ratio: np.ndarray  # weight of backing off, by the word before
    word_ratio: np.ndarray

    @classmethod
    def of(cls, toxic: ClassCounts, ordinary: ClassCounts, surroundings: np.ndarray) -> KneserNey:
        # Words without a number are unknown to both classes; they only share the total.
        shared = surroundings + 0.5
        others = shared[UNKNOWN] = surroundings[UNKNOWN] + 0.5 * max(surroundings[START], 1)
        shared[START] = 0.5
        shared = shared / (shared[START + 1 :].sum() + others)
        union = np.union1d(toxic.pairs, ordinary.pairs)
        classes = []
        for c in (toxic, ordinary):
            total = max(c.contexts.sum(), 1.0)
            left = DISCOUNT * (c.contexts > 0).sum() / total if c.contexts.sum() else 1.0
            p_word = np.maximum(c.contexts - DISCOUNT, 0) / total + left * shared
            backoff = np.where(c.after > 0, DISCOUNT * c.kinds / np.maximum(c.after, 1), 1.0)
            classes.append((c, p_word, backoff))
        p_words, backoffs = [x[1] for x in classes], [x[2] for x in classes]
        before_ratio = (np.log(backoffs[0]) - np.log(backoffs[1])) * trust(toxic.kinds + ordinary.kinds)
        word_ratio = (np.log(p_words[0]) - np.log(p_words[1])) * trust(toxic.contexts + ordinary.contexts)
        pair_ratio = np.empty(len(union), np.float32)
        for start in range(0, len(union), PAIRS_AT_ONCE):
            pairs = union[start : start + PAIRS_AT_ONCE]
            before, word = pairs // BASE, pairs % BASE
            logs, seen = [], np.zeros(len(pairs))
            for c, p_word, backoff in classes:
                own = slice(*np.searchsorted(c.pairs, [pairs[0], pairs[-1] + 1]))
                count = np.zeros(len(pairs))
                count[np.searchsorted(pairs, c.pairs[own])] = c.counts[own]
                p = np.maximum(count - DISCOUNT, 0) / np.maximum(c.after[before], 1)
                logs.append(np.log(p + backoff[before] * p_word[word]))
                seen += count
            smooth = before_ratio[before] + word_ratio[word]
            ratio = smooth + (logs[0] - logs[1] - smooth) * trust(seen, PAIR_SIGHTINGS)
            pair_ratio[start : start + PAIRS_AT_ONCE] = ratio
        return cls(union, pair_ratio, before_ratio.astype(np.float32), word_ratio.astype(np.float32))

    def compare(self, texts: list[str], ids: dict[str, int]) -> list[np.ndarray]:
        """Mean log-likelihood ratio of each text, of its most toxic word and window; 0 without words."""
        numbers, starts = numbered(texts, ids)
        ratio = np.zeros(len(numbers) + 1)
        before, word = numbers[:-1], numbers[1:]
        values = self.before_ratio[before].astype(float) + self.word_ratio[word]
        if len(self.pairs) and len(word):
            keys = before * BASE + word
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            values = np.where(self.pairs[at] == keys, self.pair_ratio[at], values)
        ratio[1:-1] = values
        ratio[starts] = 0.0
        sums = np.cumsum(ratio)  # sums[i]: up to and with position i
        ends = np.append(starts[1:], len(numbers))
        lengths = ends - starts - 1
        means = (sums[ends - 1] - sums[starts]) / np.maximum(lengths, 1)
        position = np.arange(len(numbers))
        first = np.repeat(starts, ends - starts)
        found = [means]
        for size in (1, WINDOW):
            windows = (sums[:-1] - sums[np.maximum(position - size, first)]) / size
            windows[starts] = np.where(lengths > 0, -np.inf, 0.0)
            found.append(np.maximum.reduceat(windows, starts) if len(starts) else means)
        return found


def _sample(docs, labels, key, text, label, held_out, of):
    """Labelled documents of both classes in a shared folder, and how many of each class there are.

    Only documents of ``docs`` count, and of equal texts of a class one.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & (remainder(key, of) != held_out))
        .groupBy(F.col(key).alias("_id"))
        .agg(F.max(label).alias("toxic"))
    )
    texts = docs.select(
        docs[key].alias("_id"), docs[text].alias("text"), F.md5(docs[text].cast("binary")).alias("_same")
    ).filter("text IS NOT NULL AND _id IS NOT NULL")
    spark, folder = docs.sparkSession, fresh_path(docs.sparkSession, "toxic-labels")
    (
        texts.select("_id", "_same")
        .join(known, "_id")
        .groupBy("toxic", "_same")
        .agg(F.min(F.struct(F.xxhash64("_id"), "_id")).alias("first"))
        .select("first._id", "_same", "toxic")
        .write.parquet(folder)
    )
    different = spark.read.parquet(folder)
    totals = {int(r[0]): int(r[1]) for r in different.groupBy("toxic").count().collect()}
    size = min(SAMPLE // 2, max(totals.get(1, 0), 50))
    chosen = []
    for value in (0, 1):
        chosen += (
            different.filter(F.col("toxic") == value)
            .orderBy(F.xxhash64("_id"), "_id", "_same")
            .limit(size if value else 2 * size)
            .collect()
        )
    wanted = spark.createDataFrame(
        [(r["_id"], r["_same"], int(r["toxic"])) for r in chosen],
        f"_id {docs.schema[key].dataType.simpleString()}, _same string, toxic int",
    )
    rows = (
        texts.join(F.broadcast(wanted), ["_id", "_same"])  # at most 1.5 * SAMPLE ids
        .dropDuplicates(["text", "toxic"])
        .select("text", "toxic", (F.pmod(F.xxhash64("_id"), F.lit(4)) == 0).alias("apart"))
    )
    folder = fresh_path(spark, "toxic-sample")
    rows.write.parquet(folder)
    return spark.read.parquet(folder), totals


def _vocabulary(sample: DataFrame) -> bytes:
    """All words of the sample in order, joined by line ends."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks_of_text(batches):
            words = list({w for t in texts for w in words_of(t)})
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], names=["word"])

    words = sample.select("text").mapInArrow(distinct, "word string").distinct().toArrow()["word"]
    return "\n".join(sorted(words.to_pylist())).encode()


def _class_counts(sample: DataFrame, words, size: int, toxic: int) -> ClassCounts:
    """Counts of words and word pairs in one class of the sample."""
    schema = StructType([StructField("pair", LongType()), StructField("n", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks_of_text(batches):
            numbers, _ = numbered(texts, numbers_of(words.value))
            keys, n = np.unique(pair_keys(numbers), return_counts=True)
            yield record_batch(schema, {"pair": keys, "n": n})

    spark, folder = sample.sparkSession, fresh_path(sample.sparkSession, "pairs")
    (
        sample.filter((F.col("toxic") == toxic) & ~F.col("apart"))
        .select("text")
        .mapInArrow(count, schema)
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .write.parquet(folder)
    )
    pairs = spark.read.schema(schema).parquet(folder)
    before = F.shiftright("pair", 31)

    def by_word(word, value) -> np.ndarray:
        out = np.zeros(size)
        rows = pairs.groupBy(word.alias("word")).agg(value.alias("value")).toArrow()
        out[rows["word"].to_numpy()] = rows["value"].to_numpy()
        return out

    every = pairs.toArrow()
    order = np.argsort(every["pair"].to_numpy())
    return ClassCounts(
        by_word(F.col("pair") % BASE, F.count("*")),
        by_word(before, F.sum("n")),
        by_word(before, F.count("*")),
        every["pair"].to_numpy()[order],
        every["n"].to_numpy()[order].astype(np.float32),
    )


def mixed(x: np.ndarray) -> np.ndarray:
    x = x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def packed(before: np.ndarray, word: np.ndarray) -> bytes:
    """Pairs sorted by word as differences: of words, and of the words in front of one word. Bytes of
    equal weight stand together, as those of small differences are mostly zeros."""
    same = np.diff(word, prepend=word[:1] - 1) == 0
    steps = np.where(same, np.diff(before, prepend=0), before)
    rows = np.stack([np.diff(word, prepend=0), steps])
    planes = rows.view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    """(words in front, words) as packed."""
    planes = np.frombuffer(pa.decompress(data, 16 * n, "zstd"), np.uint8).reshape(2, 8, n)
    words, steps = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64).reshape(2, n)
    first = words != 0
    sums = np.cumsum(steps)
    starts = np.flatnonzero(first)
    lead = np.repeat(sums[starts] - steps[starts], np.diff(starts, append=n))
    return np.stack([sums - lead, np.cumsum(words)])


def surroundings(docs: DataFrame, words, contexts: np.ndarray, text: str) -> np.ndarray:
    """For every word of the models, the number of different words in front of it in all documents;
    at UNKNOWN the sum of these numbers over all other words and at START how many those are.

    Tasks emit their distinct pairs, packed, in parts by a hash of the word; a word with many
    ``contexts`` in the samples is spread over several parts by the word in front. A part makes its
    pairs distinct over the corpus and counts them. What is gathered grows with the corpus, what
    reaches the driver is one number per word of the models.
    """
    parts = PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = 1 + (4 * parts * contexts / max(1.0, contexts.sum())).astype(np.int64)
    schema = StructType(
        [StructField("part", LongType()), StructField("n", LongType()), StructField("pairs", BinaryType())]
    )

    def different(pairs: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(pairs, axis=1)
        both = mixed(rows[0]) + rows[1].view(np.uint64)
        both *= np.uint64(0xBF58476D1CE4E5B9)
        return rows[:, ~pd.Series(both).duplicated().to_numpy()]

    def emitted(pairs: np.ndarray) -> pa.RecordBatch:
        before, word = pairs
        known = np.where(word < HASHED, word, UNKNOWN)
        turn = mixed(before) % spread[known].astype(np.uint64)
        part = ((mixed(word) + turn * np.uint64(7919)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((before, word, part))
        before, word, part = before[order], word[order], part[order]
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        ends = np.append(starts[1:], len(part))
        rows = [packed(before[a:b], word[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        return record_batch(schema, {"part": part[starts], "n": ends - starts, "pairs": rows})

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, size = np.zeros((2, 0), np.int64), [], 0
        for _, texts in chunks_of_text(batches, "text"):
            numbers = identified(texts, numbers_of(words.value))
            pairs = np.stack([numbers[:-1], numbers[1:]])
            waiting.append(different([pairs[:, numbers[1:] != START]]))
            size += waiting[-1].shape[1]
            if size > PAIRS_IN_TASK // 2:
                held, waiting, size = different([held, *waiting]), [], 0
                if held.shape[1] > PAIRS_IN_TASK:
                    yield emitted(held)
                    held = np.zeros((2, 0), np.int64)
        yield emitted(different([held, *waiting]))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        pairs = [unpacked(p, n) for p, n in zip(rows["pairs"], rows["n"])]
        before, word = np.concatenate(pairs, axis=1)
        order = np.lexsort((before, word))
        before, word = before[order], word[order]
        new = np.ones(len(word), bool)
        new[1:] = (np.diff(word) != 0) | (np.diff(before) != 0)
        found, n = np.unique(word[new], return_counts=True)
        known = found < HASHED
        return pd.DataFrame(
            {
                "word": np.append(found[known], UNKNOWN),
                "n": np.append(n[known], n[~known].sum()),
                "words": np.append(np.zeros(known.sum(), np.int64), (~known).sum()),
            }
        )

    rows = (
        docs.select(docs[text].alias("text"))
        .mapInArrow(distinct, schema)
        .groupBy("part")
        .applyInPandas(count, "word bigint, n bigint, words bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
        .toArrow()
    )
    counts = np.zeros(len(contexts))
    word = rows["word"].to_numpy()
    counts[word] = rows["n"].to_numpy()
    counts[START] = rows["words"].to_numpy()[word == UNKNOWN].sum()
    return counts


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    held_out: int = 2,
    of: int = 4,
    row: str | None = None,
) -> DataFrame:
    """Per document: key, held_out, score, predicted and RATIOS; with ``row`` also that column.

    Documents whose crc32(key) modulo ``of`` is ``held_out`` give no labels; their texts count
    towards the shared continuation counts, as those of all documents do. A document with several
    labels counts with its highest; null labels and keys take no part, nor do labels of documents that are not in ``docs`` or have
    no text; of equal texts of a class one counts. If a class has no document, or the part of the
    sample that is counted or the part that is fitted lacks one, every score is the share of label 1,
    0 without labels. A null text is empty and scores by ratios of 0. Texts are scored whole. Repeated rows are scored each.
    """
    spark = docs.sparkSession
    own = [row] if row else []
    apart = F.coalesce(remainder(key, of) == held_out, F.lit(False))
    sample, totals = _sample(docs, labels, key, text, label, held_out, of)
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    parts = sample.select("toxic", "apart").distinct().count()
    if parts < 4:
        score = F.lit(float(share))
        return docs.select(
            docs[key].alias(key), *own, apart.alias("held_out"), score.alias("score"),
            (score >= THRESHOLD).cast("int").alias("predicted"),
            *(F.lit(0.0).alias(r) for r in RATIOS),
        )
    vocabulary = _vocabulary(sample.filter("NOT apart"))
    size = vocabulary.count(b"\n") + 1 + START + 1
    words = spark.sparkContext.broadcast(vocabulary)
    toxic, ordinary = (_class_counts(sample, words, size, c) for c in (1, 0))
    shared = surroundings(docs, words, toxic.contexts + ordinary.contexts, text)
    model = spark.sparkContext.broadcast(KneserNey.of(toxic, ordinary, shared))
    del toxic, ordinary

    # Probability from the ratios, on documents that were not counted.
    fitted = _ratios(sample.filter("apart").select("toxic", "text"), words, model).toPandas()
    weights = _calibration(fitted, totals)

    rows = docs.select(docs[key].alias(key), *own, docs[text].alias("text"))
    z = F.lit(weights[0])
    for name, weight in zip(RATIOS, weights[1:]):
        z = z + weight * F.col(name)
    return (
        _ratios(rows, words, model)
        .withColumn("score", 1.0 / (1.0 + F.exp(-z)))
        .select(
            key, *own, apart.alias("held_out"), "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
            *RATIOS,
        )
    )


def _calibration(fitted: pd.DataFrame, totals: dict[int, int]) -> list[float]:
    """Intercept and non-negative weights of the ratios; both classes have rows."""
    toxic = fitted["toxic"].to_numpy()
    by_class = np.array([totals.get(c, 0) / max(1, (toxic == c).sum()) for c in (0, 1)])
    weights, signs = by_class[toxic], np.where(toxic == 1, 1.0, -1.0)
    columns = list(RATIOS)
    while columns:
        rows = fitted[columns].to_numpy()
        centre, scale = rows.mean(0), rows.std(0) + 1e-9
        design = np.column_stack([np.ones(len(rows)), (rows - centre) / scale])
        w = logistic(design, signs, 1e-3, weights)
        slopes = w[1:] / scale
        if (slopes >= 0).all():
            found = dict(zip(columns, slopes))
            intercept = float(w[0] - slopes @ centre)
            return [intercept, *(float(found.get(r, 0.0)) for r in RATIOS)]
        columns = [c for c, x in zip(columns, slopes) if x > 0]
    return [float(np.log(totals[1] / totals[0]))] + [0.0] * len(RATIOS)  # the share of label 1


def _ratios(rows: DataFrame, words, model) -> DataFrame:
    """All columns but the text, with the ratios."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = StructType(
        kept + [StructField(n, DoubleType()) for n in RATIOS]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks_of_text(batches):
            ratios = dict(zip(RATIOS, model.value.compare(texts, numbers_of(words.value))))
            yield record_batch(schema, {**{f.name: part.column(f.name) for f in kept}, **ratios})

    return rows.mapInArrow(compare, schema)
