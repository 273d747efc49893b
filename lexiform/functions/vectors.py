"""Vector expressions over arrays and ML vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_array(df: DataFrame, column: str) -> Column:
    """The column as an array of doubles, whatever kind of vector it holds."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        return F.col(column).cast("array<double>")
    if isinstance(kind, T.NumericType):
        return F.array(F.col(column).cast("double"))
    return vector_to_array(F.col(column))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value computed once per row and not once per element."""
    return F.get(F.transform(F.array(value), body), 0)


def l2_normalize(vector: Column | str) -> Column:
    """The vector scaled to unit length; the zero vector stays as it is."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))
    scaled = bound(norm, lambda n: F.transform(vector, lambda x: x / F.nullif(n, F.lit(0.0))))
    return F.when(norm > 0, scaled).otherwise(vector)


def minkowski_distance(left: Column | str, right: Column | str, p: float = 2) -> Column:
    """The p-th root of the sum of absolute differences to the power p."""
    if p == 1:
        powers = F.zip_with(left, right, lambda a, b: F.abs(a - b))
    elif p == 2:
        powers = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    else:
        powers = F.zip_with(left, right, lambda a, b: F.pow(F.abs(a - b), F.lit(float(p))))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
    if p == 1:
        return total
    return F.sqrt(total) if p == 2 else F.pow(total, F.lit(1.0 / p))


def softmax(logits: Column | str) -> Column:
    """Logits as probabilities, shifted by the maximum against overflow."""
    logits = F.col(logits) if isinstance(logits, str) else logits

    def shares(powers):
        total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
        return bound(total, lambda t: F.transform(powers, lambda x: x / t))

    powers = bound(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top)))
    return bound(powers, shares)


def argmax(scores: Column | str) -> Column:
    """Position of the largest score, the first one on a tie."""
    scores = F.col(scores) if isinstance(scores, str) else scores
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def decide_class(column: Column | str, mode: str, n_classes: int = 2) -> Column:
    """Class code from a model's output.

    ``argmax``: from an array of scores. ``threshold``: 1 above one half.
    ``score``: a score in [0, 1] is cut at one half for two classes and rounded
    for more; anything else is taken as the code itself. ``label``: unchanged.
    """
    column = F.col(column) if isinstance(column, str) else column
    above_half = (column > F.lit(0.5)).cast("int")
    if mode == "argmax":
        return argmax(column)
    if mode == "threshold":
        return above_half
    if mode == "score":
        inside = above_half if n_classes == 2 else F.bround(column, 0).cast("int")
        return F.when(column.between(0, 1), inside).otherwise(column.cast("int"))
    if mode == "label":
        return column.cast("int")
    raise ValueError(f"unknown mode: {mode}")


def expanded(array: Column, size: int, prefix: str) -> list[Column]:
    """One column per dimension, named prefix_0, prefix_1, ..."""
    return [F.get(array, i).alias(f"{prefix}_{i}") for i in range(size)]


def sparse_entries(vector: Column | str) -> Column:
    """Stored entries of an ML vector as an array of (index, value)."""
    inner = F.unwrap_udt(vector)
    dense = F.transform(inner["values"], lambda v, i: F.struct(i.alias("index"), v.alias("value")))
    sparse = F.zip_with(
        inner["indices"],
        inner["values"],
        lambda i, v: F.struct(i.alias("index"), v.alias("value")),
    )
    return F.when(inner["type"] == 0, sparse).otherwise(dense)
