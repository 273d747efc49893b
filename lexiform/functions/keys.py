"""Reproducible pseudo-random keys, the same on every engine that has md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(identifier: Column | str, seed: int | str) -> Column:
    """32 hexadecimal digits that depend on the row id and the seed only."""
    identifier = F.col(identifier) if isinstance(identifier, str) else identifier
    return F.md5(F.concat(identifier.cast("string"), F.lit(f":{seed}")))


def unit_interval(hashed: Column) -> Column:
    """A number in [0, 1) from the first eight digits of a hash."""
    return F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
