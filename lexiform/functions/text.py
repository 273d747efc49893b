"""Text expressions. Every one maps a column to a column of the same row."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A word is a run of two or more letters, digits or underscores.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

# The characters on which white-space tokenising splits.
SPACE_PATTERN = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x85\\xA0\\u1680\\u2000-\\u200A"
    "\\u2028\\u2029\\u202F\\u205F\\u3000]+"
)

# Characters of text that a task holds as Python objects at a time.
SLICE_CHARS = 1_000_000


def text_or_empty(column: Column | str) -> Column:
    """The column as a string, with null as the empty string."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def join_text(columns: Sequence[str]) -> Column:
    """Several columns joined by one space, in the given order."""
    return F.concat_ws(" ", *[text_or_empty(name) for name in columns])


def tokenize_words(column: Column | str) -> Column:
    """Lower-case words of two or more word characters."""
    return F.regexp_extract_all(F.lower(text_or_empty(column)), F.lit(WORD_PATTERN), F.lit(0))


def tokenize_whitespace(column: Column | str) -> Column:
    """Lower-case runs of non-space characters."""
    parts = F.split(F.lower(text_or_empty(column)), SPACE_PATTERN)
    return F.filter(parts, lambda part: part != "")


def remove_stop_words(tokens: Column | str, stop_words: Sequence[str]) -> Column:
    """Tokens that are not stop words, in order."""
    if not stop_words:
        return F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(tokens, lambda token: ~token.isin(list(stop_words)))


def text_slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of an Arrow array of texts of about SLICE_CHARS bytes; a longer text is taken alone."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0))
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_CHARS, "right")))
        yield texts.slice(start, stop - start)
        start = stop


@F.arrow_udf(T.StringType())
def strip_accents(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Compatibility decomposition without the combining marks."""

    def strip(text):
        if text is None or text.isascii():
            return text
        decomposed = unicodedata.normalize("NFKD", text)
        return "".join(c for c in decomposed if not unicodedata.combining(c))

    for batch in batches:
        for part in text_slices(batch):
            yield pa.array([strip(text) for text in part.to_pylist()], pa.string())


def sublinear(tf: Column | str) -> Column:
    """Dampened count: 1 + ln(tf)."""
    return F.lit(1.0) + F.log(tf)
