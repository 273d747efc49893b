"""Metrics of a ranking by score, exact with ties, without sorting all rows in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.cluster import checkpointed, settled

# Distinct scores that one task adds up.
RANGE_SCORES = 500_000


def running_sums(rows: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Add ``<value>_before`` to rows of distinct keys: the sum over all smaller keys.

    Keys are dealt out by range; a task adds up its own, on top of the totals of the ranges before.
    """
    rows = checkpointed(rows)
    ranges = max(1, math.ceil(rows.count() / RANGE_SCORES))
    dealt = checkpointed(
        rows.repartitionByRange(ranges, key).withColumn("_range", F.spark_partition_id())
    )
    smaller = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_range").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    starts, small = settled(
        totals.select(
            "_range", *[F.coalesce(F.sum(f"_{v}").over(smaller), F.lit(0)).alias(f"_{v}") for v in values]
        )
    )
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    before = {
        f"{v}_before": F.col(f"_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values
    }
    return (
        dealt.join(F.broadcast(starts) if small else starts, "_range")
        .withColumns(before)
        .drop("_range", *[f"_{v}" for v in values])
    )


def score_counts(df: DataFrame, positive: Column, score: Column) -> DataFrame:
    """Per distinct score: the positive and the negative rows, and those of all smaller scores.

    Rows whose score or class is unknown are left out. Tied rows are counted before they move.
    """
    marked = df.select(score.cast("double").alias("score"), positive.alias("positive"))
    marked = marked.filter("positive IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)")
    counts = marked.groupBy("score").agg(
        F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg")
    )
    return running_sums(counts, "score", ["pos", "neg"])


def ranking_scores(df: DataFrame, positive: Column, score: Column) -> DataFrame:
    """One row: roc_auc, average_precision, n_positive, n_negative.

    The area under the curve counts a tie of a positive and a negative row as half. The average
    precision sums the precision at each distinct score by the recall that it adds. Both are null
    without positive rows, the area also without negative ones.
    """
    counts = score_counts(df, positive, score)
    pos, neg = F.sum("pos"), F.sum("neg")
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    all_pos, all_neg = F.first("_pos"), F.first("_neg")
    totals = counts.agg(pos.alias("_pos"), neg.alias("_neg"))
    # At a threshold, the rows at least as high.
    hits = F.col("_pos") - F.col("pos_before")
    taken = hits + F.col("_neg") - F.col("neg_before")
    return counts.join(F.broadcast(totals)).agg(
        F.try_divide(won, all_pos * all_neg).alias("roc_auc"),
        F.try_divide(F.sum(F.col("pos") * hits / taken), all_pos).alias("average_precision"),
        F.coalesce(all_pos, F.lit(0)).alias("n_positive"),
        F.coalesce(all_neg, F.lit(0)).alias("n_negative"),
    )


def roc_auc(df: DataFrame, positive: Column, score: Column) -> float | None:
    return ranking_scores(df, positive, score).first()["roc_auc"]


def average_precision(df: DataFrame, positive: Column, score: Column) -> float | None:
    return ranking_scores(df, positive, score).first()["average_precision"]
