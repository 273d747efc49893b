"""Standardising features by population mean and deviation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiform.functions.vectors import as_array


def feature_moments(df: DataFrame, column: str = "features") -> tuple[list[float], list[float]]:
    """Mean and scale of each dimension; a constant dimension has scale 1.

    One distributed pass; two numbers per dimension reach the driver.
    """
    vectors = df.select(array_to_vector(as_array(df, column)).alias("_v"))
    row = vectors.agg(
        Summarizer.metrics("mean", "variance", "count").summary(F.col("_v")).alias("_s")
    ).first()["_s"]
    shrink = (row["count"] - 1) / row["count"]
    scale = [(v * shrink) ** 0.5 if v > 0 else 1.0 for v in row["variance"]]
    return [float(m) for m in row["mean"]], scale


def standardized(array: Column, mean: list[float], scale: list[float]) -> Column:
    """The array with each dimension centred and scaled, a batch of rows at a time."""
    centre, spread = np.array(mean), np.array(scale)

    @F.pandas_udf("array<double>")
    def scaled(rows: pd.Series) -> pd.Series:
        present = rows.notna().to_numpy()
        made = pd.Series([None] * len(rows), dtype=object)
        if present.any():
            block = (np.stack(rows[present].to_numpy()) - centre) / spread
            made[present] = pd.Series(list(block), index=made.index[present])
        return made

    return scaled(array)


def standardize_features(
    train: DataFrame, df: DataFrame | None = None, column: str = "features", output: str = "scaled"
) -> DataFrame:
    """Standardise any frame by the moments of the training frame."""
    df = train if df is None else df
    mean, scale = feature_moments(train, column)
    return df.withColumn(output, standardized(as_array(df, column), mean, scale))
