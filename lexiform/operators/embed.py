"""Dense text embeddings by a pluggable encoder."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiform.cluster import checkpointed, settled
from lexiform.functions.text import SLICE_CHARS, text_or_empty, text_slices

# An encoder maps a list of texts to one row of numbers per text.
Encoder = Callable[[Sequence[str]], np.ndarray]

# The hashing encoder forgets the slots of words when it knows this many.
REMEMBERED_WORDS = 200_000

# Rows of one text that meet its embedding in one task, and how many texts may have more of them.
COPIES = 100_000
HOT_TEXTS = 10_000


def hashing_encoder(size: int = 64) -> Encoder:
    """Signed feature hashing of words, scaled to unit length.

    It needs no model file, so it stands in for a sentence encoder wherever the
    plumbing matters and not the quality.
    """

    words = re.compile(r"\w{2,}")
    slots: dict[str, int] = {}

    def slot(word: str) -> int:
        """Twice the dimension of a word, plus one if its sign is positive."""
        digest = hashlib.md5(word.encode()).hexdigest()
        return int(digest[:8], 16) % size * 2 + int(digest[8], 16) % 2

    def add(texts: Sequence[str], vectors: np.ndarray) -> None:
        """Add up the words of some texts."""
        if len(slots) > REMEMBERED_WORDS:
            slots.clear()
        found = [words.findall(text.lower()) for text in texts]
        slots.update((w, slot(w)) for w in set().union(*found).difference(slots))
        codes = np.array([slots[w] for ws in found for w in ws], dtype=np.int64)
        rows = np.repeat(np.arange(len(texts)), [len(ws) for ws in found])
        np.add.at(vectors, (rows, codes // 2), np.where(codes % 2, 1.0, -1.0))

    def encode(texts: Sequence[str]) -> np.ndarray:
        vectors = np.zeros((len(texts), size))
        # The words of a slice are held as Python objects, never those of all texts.
        ends = np.cumsum([len(text) for text in texts])
        start = 0
        while start < len(texts):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_CHARS, "right")))
            add(texts[start:stop], vectors[start:stop])
            start = stop
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.divide(vectors, norms, out=vectors, where=norms > 0)

    return encode


def rows_as_arrow(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow array of lists."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.ravel()))


def embed_text(
    df: DataFrame,
    make_encoder: Callable[[], Encoder] = hashing_encoder,
    text: str = "text",
    output: str = "embedding",
    once: bool = False,
) -> DataFrame:
    """Add the embedding of each text as an array; null counts as empty.

    The encoder is made once per task and fed slices of Arrow batches, of about
    a million characters, so that a task holds few texts at a time. With ``once``
    equal texts are encoded a single time, which pays if the encoder costs more
    than a shuffle of the rows.
    """
    if once:
        return encoded_once(
            df, lambda texts: embed_text(texts, make_encoder, text, output), text, [output]
        )

    @F.arrow_udf("array<double>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = make_encoder()
        for batch in batches:
            for part in text_slices(batch):
                yield rows_as_arrow(np.asarray(encoder(part.to_pylist()), dtype=float))

    # Not to be repeated by the optimiser, which duplicates deterministic functions.
    return df.withColumn(output, encode.asNondeterministic()(text_or_empty(text)))


def embed_text_batched(
    df: DataFrame,
    make_encoder: Callable[[], Encoder] = hashing_encoder,
    size: int = 1536,
    batch_size: int = 100,
    pause: float = 0.0,
    text: str = "text",
    output: str = "embedding",
    once: bool = False,
) -> DataFrame:
    """Embeddings from a service that takes ``batch_size`` texts and may fail.

    A failed batch yields zero vectors of the width seen so far in the task
    (``size`` before the first success) and ``embed_ok`` false. ``pause``
    seconds pass between the calls of a task. With ``once`` equal texts are sent
    a single time and share what comes back.
    """
    if once:

        def encode_texts(texts: DataFrame) -> DataFrame:
            return embed_text_batched(texts, make_encoder, size, batch_size, pause, text, output)

        return encoded_once(df, encode_texts, text, [output, "embed_ok"])

    @F.arrow_udf("struct<embedding: array<double>, embed_ok: boolean>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, width, calls = make_encoder(), size, 0
        for batch in batches:
            for start in range(0, len(batch), batch_size):
                texts = batch.slice(start, batch_size).to_pylist()
                if calls and pause:
                    time.sleep(pause)
                calls += 1
                try:
                    rows = np.asarray(encoder(texts), dtype=float)
                    if rows.shape[0] != len(texts):
                        raise ValueError("the encoder returned another number of rows")
                    width, ok = rows.shape[1], True
                except Exception:
                    rows, ok = np.zeros((len(texts), width)), False
                yield pa.StructArray.from_arrays(
                    [rows_as_arrow(rows), pa.array(np.full(len(texts), ok))],
                    ["embedding", "embed_ok"],
                )

    encoded = df.withColumn("_encoded", encode.asNondeterministic()(text_or_empty(text)))
    return encoded.select(
        *[c for c in df.columns if c not in (output, "embed_ok")],
        F.col("_encoded.embedding").alias(output),
        F.col("_encoded.embed_ok").alias("embed_ok"),
    )


def encoded_once(
    df: DataFrame, encode: Callable[[DataFrame], DataFrame], text: str, outputs: Sequence[str]
) -> DataFrame:
    """Add what ``encode`` adds to a table of texts, computed for each different text once.

    Different texts are found by digest and encoded to a table, which rows then
    meet by digest. A text with very many copies is met in several tasks: its
    rows are dealt out by a number, and its embedding is repeated for each.
    """
    digest = F.sha2(text_or_empty(text).cast("binary"), 256)
    keyed = df.withColumn("_digest", digest)
    different = keyed.groupBy("_digest").agg(
        F.first(text_or_empty(text)).alias(text), F.count("*").alias("_copies")
    )
    done = checkpointed(encode(different).select("_digest", "_copies", *outputs))
    parts = F.ceil(F.col("_copies") / F.lit(float(COPIES))).cast("int")
    hot = done.filter(F.col("_copies") > COPIES).orderBy(F.desc("_copies"), "_digest").limit(HOT_TEXTS)
    hot, _ = settled(hot.select("_digest", parts.alias("_parts")))
    row = F.xxhash64(F.monotonically_increasing_id())
    dealt = keyed.join(F.broadcast(hot), "_digest", "left").withColumn(
        "_part", F.coalesce(F.pmod(row, F.col("_parts")).cast("int"), F.lit(0))
    )
    every = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    spread = done.join(F.broadcast(hot), "_digest", "left").withColumn("_part", F.explode(every))
    kept = [c for c in df.columns if c not in outputs]
    return dealt.drop(*outputs).join(spread.select("_digest", "_part", *outputs), ["_digest", "_part"]).select(
        *kept, *outputs
    )
