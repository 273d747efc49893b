"""Small helpers for Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Characters of text that a task holds as Python objects at a time; one longer text is taken alone.
CHUNK_CHARS = 1_000_000


def chunks_of_text(
    batches: Iterable[pa.RecordBatch], column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts (a null text is empty), bounded by characters."""
    for batch in batches:
        lengths = np.asarray(
            pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
        )
        start, rows = 0, batch.num_rows
        ends = np.cumsum(lengths)
        while start < rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_CHARS, "right")))
            part = batch.slice(start, stop - start)
            yield part, [t or "" for t in part.column(column).to_pylist()]
            start = stop


def record_batch(schema: StructType, columns: dict) -> pa.RecordBatch:
    """Columns by name as a batch of a Spark schema; ready Arrow arrays are kept."""
    fields = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [
            c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type)
            for f in fields
        ],
        schema=fields,
    )


def remainder(identifier: Column | str, of: int) -> Column:
    """crc32 of an id written as text, modulo ``of``; null for a null id."""
    identifier = F.col(identifier) if isinstance(identifier, str) else identifier
    return F.crc32(identifier.cast("string").cast("binary")) % of
