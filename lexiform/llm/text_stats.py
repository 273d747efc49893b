"""Counts that describe a whole text, measured once per document inside tasks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from lexiform.llm.batches import chunks_of_text, record_batch

WHITE = " \t\n\r\x0b\x0c"  # a word is a run of other characters
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

COUNTS = [
    "n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_upper", "n_lower", "n_exclaims", "n_stops", "n_digits", "n_distinct_words", "n_top_word",
]


def count_of(text: bytes, characters: bytes) -> int:
    return len(text) - len(text.translate(None, characters))


def repeated_words(words: list[list[bytes]]) -> list[int]:
    """Words of each text inside 8-word windows that the text holds twice or more.

    Windows are hashed together; those whose hashes meet are then compared word by word.
    """
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    total = int(lengths.sum())
    if total < WINDOW:
        return [0] * len(words)
    hashes = np.fromiter((hash(w) for ws in words for w in ws), np.int64, total).view(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    n = total - WINDOW + 1
    keys = owner[:n].astype(np.uint64)
    for i in range(WINDOW):
        keys = keys * np.uint64(6364136223846793005) + hashes[i : i + n]
        keys ^= keys >> np.uint64(29)
    inside = owner[:n] == owner[WINDOW - 1 :]
    starts = np.flatnonzero(inside)
    met = starts[pd.Series(keys[starts]).duplicated(keep=False).to_numpy()]
    if not len(met):
        return [0] * len(words)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    windows = []
    for start in met.tolist():
        text = int(owner[start])
        at = start - int(offsets[text])
        windows.append((text, *words[text][at : at + WINDOW]))
    seen = Counter(windows)
    covered = np.zeros(total + 1, np.int32)
    for start, window in zip(met.tolist(), windows):
        if seen[window] > 1:
            covered[start] += 1
            covered[start + WINDOW] -= 1
    covered = np.cumsum(covered)[:total] > 0
    return np.bincount(owner[covered], minlength=len(words)).tolist()


def repeated_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return len(lines), len(lines) - len(set(lines))


def measure(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: dict[str, str] | None = None
) -> DataFrame:
    """The key, the columns of ``keep`` (source name by result name) and COUNTS, row by row.

    A null text counts as empty; then every count is 0. Texts are read whole.
    """
    keep = keep or {}
    rows = docs.select(
        docs[key].alias(key), *(docs[source].alias(name) for name, source in keep.items()),
        docs[text].alias("_text"),
    )
    names = rows.columns[:-1]
    schema = StructType(rows.schema.fields[:-1] + [StructField(c, LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks_of_text(batches, "_text"):
            coded = [t.encode("utf-8", "surrogatepass") for t in texts]
            words = [c.split() for c in coded]
            columns: dict = {c: [] for c in COUNTS}
            for t, c, ws in zip(texts, coded, words):
                lines, repeats = repeated_lines(t)
                tally = Counter(ws)
                values = (
                    len(t), len(ws), len(t) - count_of(c, WHITE.encode()), count_of(c, SYMBOLS),
                    lines, repeats, 0,
                    count_of(c, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                    count_of(c, b"abcdefghijklmnopqrstuvwxyz"),
                    count_of(c, b"!?"), count_of(c, b".,;:"), count_of(c, b"0123456789"),
                    len(tally), max(tally.values(), default=0),
                )
                for name, value in zip(COUNTS, values):
                    columns[name].append(value)
            columns["n_repeat_words"] = repeated_words(words)
            yield record_batch(schema, {**{n: part.column(n) for n in names}, **columns})

    return rows.mapInArrow(run, schema)
