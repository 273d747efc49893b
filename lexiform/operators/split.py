"""Reproducible stratified splits and shuffles that never sort a class in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiform.cluster import join_dimension, settled
from lexiform.functions.keys import seeded_hash

# At most about this many rows are ranked in one task.
RANKED_ROWS = 1_000_000

# Hash digits by which a group of rows is divided in one step.
STEP = 2


def stratified_quotas(
    df: DataFrame, target: str = "target", test_size: float = 0.2
) -> DataFrame:
    """Training rows per class by largest remainder: target, n, quota.

    The test share is rounded up. Ties of the remainder go to the smaller class.
    """
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    everything = Window.partitionBy()
    big = "decimal(38,0)"
    total = counts.select(
        target,
        "n",
        F.min("n").over(everything).alias("smallest"),
        F.count("*").over(everything).alias("classes"),
        F.sum("n").over(everything).alias("rows"),
    )
    sized = total.withColumn(
        "n_test", F.ceil(F.lit(float(test_size)) * F.col("rows")).cast("bigint")
    ).withColumn("n_train", F.col("rows") - F.col("n_test"))
    checked = sized.withColumn(
        "n_train",
        F.when(F.col("smallest") < 2, F.raise_error(F.lit("a class has fewer than two rows")))
        .when(
            F.least("n_test", "n_train") < F.col("classes"),
            F.raise_error(F.lit("fewer rows than classes on one side of the split")),
        )
        .otherwise(F.col("n_train")),
    )
    product = F.col("n").cast(big) * F.col("n_train").cast(big)
    shares = checked.select(
        target,
        "n",
        "n_train",
        F.expr("cast(n as decimal(18,0)) * cast(n_train as decimal(18,0)) div rows").alias("base"),
        (product % F.col("rows").cast(big)).alias("remainder"),
    )
    missing = F.col("n_train") - F.sum("base").over(everything)
    place = F.row_number().over(Window.orderBy(F.desc("remainder"), F.asc(target)))
    return shares.select(
        target, "n", (F.col("base") + (place <= missing).cast("int")).cast("bigint").alias("quota")
    )


def _cut_points(keyed: DataFrame, quotas: DataFrame, group: str) -> DataFrame:
    """The last key of each group that lies within the group's quota.

    A radix descent: count the rows below each hash prefix, keep the prefix in
    which the quota ends, and go on inside it until few enough rows are left to
    be ranked.
    """
    state, small = settled(
        quotas.select(
            group, F.col("quota").alias("wanted"), F.col("n").alias("held"), F.lit("").alias("prefix")
        )
    )

    def inside():
        side = F.broadcast(state) if small else state
        return keyed.join(side, group).filter(F.startswith("_key", F.col("prefix")))

    depth = 0
    while depth < 32 and (state.agg(F.max("held")).first()[0] or 0) > RANKED_ROWS:
        depth += STEP
        counts = (
            inside()
            .groupBy(group, "wanted", F.substring("_key", 1, depth).alias("prefix"))
            .agg(F.count("*").alias("held"))
        )
        upto = F.sum("held").over(Window.partitionBy(group).orderBy("prefix"))
        state, small = settled(
            counts.withColumn("_upto", upto)
            .filter((F.col("_upto") >= F.col("wanted")) & (F.col("_upto") - F.col("held") < F.col("wanted")))
            .select(group, (F.col("wanted") - F.col("_upto") + F.col("held")).alias("wanted"), "held", "prefix")
        )
    place = F.row_number().over(Window.partitionBy(group).orderBy("_key", "_id"))
    return (
        inside()
        .withColumn("_place", place)
        .filter(F.col("_place") == F.col("wanted"))
        .select(group, F.col("_key").alias("_cut"), F.col("_id").alias("_cut_id"))
    )


def stratified_split(
    df: DataFrame,
    identifier: str = "doc_id",
    target: str = "target",
    test_size: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add a column ``split`` of train or test, with exact class proportions.

    Rows of a class are taken in the order of a seeded hash of their id, which
    must be unique. Once the cut of each class is known the side of a row
    depends on the row alone, so the table itself is not shuffled.
    """
    keyed = df.select(
        F.col(target), F.col(identifier).alias("_id"), seeded_hash(identifier, seed).alias("_key")
    )
    cuts = _cut_points(keyed, stratified_quotas(df, target, test_size), target)
    marked = join_dimension(
        df.withColumn("_key", seeded_hash(identifier, seed)), cuts, target
    )
    within = (F.col("_key") < F.col("_cut")) | (
        (F.col("_key") == F.col("_cut")) & (F.col(identifier) <= F.col("_cut_id"))
    )
    side = F.when(F.coalesce(within, F.lit(False)), "train").otherwise("test")
    return marked.withColumn("split", side).select(*df.columns, "split")


def train_test(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """The two sides of a stratified split, without rows that hold a null."""
    marked = stratified_split(df, **options)

    def side(name: str) -> DataFrame:
        return marked.filter(F.col("split") == name).drop("split").na.drop("any")

    return side("train"), side("test")


def shuffle_rows(df: DataFrame, identifier: str = "doc_id", seed: int = 42) -> DataFrame:
    """Add ``position``, each row's place from 1 in the order of a seeded hash.

    Rows are ranked inside prefixes of the hash, which are even by nature, and
    the prefixes are placed by their counts.
    """
    rows = df.count()
    digits = max(1, math.ceil(math.log(max(1.0, rows / RANKED_ROWS), 16)))
    keyed = df.withColumn("_key", seeded_hash(identifier, seed)).withColumn(
        "_prefix", F.substring("_key", 1, digits)
    )
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("_prefix")
        .agg(F.count("*").alias("_n"))
        .select("_prefix", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy("_prefix").orderBy("_key", identifier))
    return (
        join_dimension(keyed, starts, "_prefix", "inner")
        .withColumn("position", (F.col("_start") + place).cast("bigint"))
        .drop("_key", "_prefix", "_start")
    )
