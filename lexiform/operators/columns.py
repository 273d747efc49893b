"""Column selection by pattern, text columns, and vectors as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiform.functions.text import join_text
from lexiform.functions.vectors import as_array, expanded


def matching_columns(columns: Sequence[str], patterns: Sequence[str]) -> list[str]:
    """Columns that match a name, a ``prefix*`` or ``*``; unknown names match nothing."""
    found = {}
    for pattern in patterns:
        prefix = pattern[:-1] if pattern.endswith("*") else None
        for name in columns:
            if name == pattern or (prefix is not None and name.startswith(prefix)):
                found.setdefault(name)
    return list(found)


def chosen_columns(
    columns: Sequence[str], include: Sequence[str] = ("*",), exclude: Sequence[str] = ()
) -> list[str]:
    """Included columns that are not excluded, in the order of inclusion."""
    excluded = set(matching_columns(columns, exclude))
    chosen = [name for name in matching_columns(columns, include) if name not in excluded]
    if not chosen:
        raise ValueError(f"no columns left: include {list(include)}, exclude {list(exclude)}")
    return chosen


def select_features(
    df: DataFrame, include: Sequence[str] = ("*",), exclude: Sequence[str] = ()
) -> DataFrame:
    """Only the chosen columns."""
    return df.select(*chosen_columns(df.columns, include, exclude))


def concat_text(
    df: DataFrame,
    include: Sequence[str] = ("*",),
    exclude: Sequence[str] = (),
    output: str = "text",
) -> DataFrame:
    """Add the chosen columns as one text; null counts as empty."""
    return df.withColumn(output, join_text(chosen_columns(df.columns, include, exclude)))


def feature_prefix(columns: Sequence[str]) -> str:
    """Prefix of generated columns: up to three source names, else ``features``."""
    return "_".join(columns) if len(columns) <= 3 else "features"


def expand_vector(
    df: DataFrame, column: str, size: int | None = None, prefix: str | None = None
) -> DataFrame:
    """Add one column per dimension. Only on request: wide schemas are slow.

    Without ``size`` it is taken from the first row.
    """
    array = as_array(df, column)
    if size is None:
        first = df.select(F.size(array)).first()
        size = first[0] if first else 0
    return df.select("*", *expanded(array, size, prefix or column))


def probability_columns(
    df: DataFrame, n_classes: int, column: str = "probability", prediction: str = "prediction"
) -> DataFrame:
    """Add class probabilities as prediction_proba_0, prediction_proba_1, ..."""
    return expand_vector(df, column, n_classes, f"{prediction}_proba")


def assemble_features(
    df: DataFrame,
    include: Sequence[str] = ("*",),
    exclude: Sequence[str] = (),
    output: str = "features",
) -> DataFrame:
    """Add the chosen numeric columns as one vector; null or NaN is an error."""
    chosen = chosen_columns(df.columns, include, exclude)
    return VectorAssembler(inputCols=chosen, outputCol=output, handleInvalid="error").transform(df)
