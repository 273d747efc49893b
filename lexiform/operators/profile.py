"""Class counts, class names and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.cluster import join_dimension


def class_name(target: str = "target") -> Column:
    """The default name of a class code."""
    return F.concat(F.lit("class_"), F.col(target).cast("string"))


def class_distribution(df: DataFrame, target: str = "target") -> DataFrame:
    """Rows per class with the totals: target, target_name, n, n_samples, n_classes.

    The window runs over the class counts, not over the rows.
    """
    everything = Window.partitionBy()
    return (
        df.groupBy(target)
        .agg(F.count("*").alias("n"))
        .select(
            target,
            class_name(target).alias("target_name"),
            "n",
            F.sum("n").over(everything).alias("n_samples"),
            F.count("*").over(everything).alias("n_classes"),
        )
        .orderBy(target)
    )


def ranked_codes(df: DataFrame, value: str, code: str) -> DataFrame:
    """Distinct values and their rank in sorted order, from 0."""
    rank = F.row_number().over(Window.orderBy(value)) - 1
    return df.filter(F.col(value).isNotNull()).select(value).distinct().withColumn(
        code, rank.cast("int")
    )


def target_names(df: DataFrame, target: str = "target") -> DataFrame:
    """Distinct class codes in order with their default names."""
    return (
        df.select(target)
        .distinct()
        .select(target, class_name(target).alias("target_name"))
        .orderBy(target)
    )


def label_predictions(
    predictions: DataFrame, names: DataFrame, column: str = "prediction"
) -> DataFrame:
    """Add the class name of each predicted code; names: target, target_name."""
    lookup = names.select(
        F.col("target").cast("int").alias("_code"), F.col("target_name").alias(f"{column}_name")
    )
    coded = predictions.withColumn("_code", F.col(column).cast("int"))
    return join_dimension(coded, lookup, "_code").drop("_code")


def dataset_summary(df: DataFrame, split: str = "split", target: str = "target") -> DataFrame:
    """Rows per split and class, per split, per class and in all.

    A null split or target in the result means "all of them".
    """
    counted = df.groupingSets(
        [[split, target], [split], [target], []], split, target
    ).agg(
        F.count("*").alias("n"),
        F.grouping(split).cast("int").alias("all_splits"),
        F.grouping(target).cast("int").alias("all_targets"),
    )
    return counted


def feature_info(kind: str, **facts) -> dict:
    """Description of a fitted extractor or model, numbers and settings only."""
    return {"feature_type": kind, **{k: v for k, v in facts.items() if v is not None}}
