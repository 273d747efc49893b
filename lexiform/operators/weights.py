"""Class weights for imbalanced labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiform.cluster import join_dimension


def class_weights(df: DataFrame, target: str = "target") -> DataFrame:
    """Balanced weights n / (classes * rows of the class): target, n, weight."""
    everything = Window.partitionBy()
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    share = F.col("n").cast("double") * F.count("*").over(everything)
    return counts.withColumn("weight", F.sum("n").over(everything).cast("double") / share)


def with_class_weight(
    df: DataFrame, weights: DataFrame, target: str = "target", column: str = "weight"
) -> DataFrame:
    """Attach each row's class weight; a class without a weight gets 1."""
    lookup = weights.select(target, F.col("weight").alias(column))
    joined = join_dimension(df, lookup, target)
    return joined.withColumn(column, F.coalesce(F.col(column), F.lit(1.0)))


def with_copies(df: DataFrame, weight: str, identifier: str) -> DataFrame:
    """Repeat rows in proportion to their weight, for trainers without weights.

    Weights are scaled so that the smallest is 1 and no row is lost; the
    fractional part of a weight is settled by a hash of the row id.
    """
    smallest = df.agg(F.min(weight)).first()[0]
    scaled = F.col(weight) / F.lit(smallest)
    uniform = F.pmod(F.xxhash64(F.col(identifier)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    copies = F.floor(scaled) + (uniform < scaled - F.floor(scaled)).cast("int")
    many = df.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.greatest(copies, F.lit(1)).cast("int")))
    )
    # The copies of a heavy row would otherwise stay in its partition.
    return many.repartition(F.col(identifier), F.col("_copy")).drop("_copy")
