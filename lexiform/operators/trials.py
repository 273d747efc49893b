"""Analytics over a table of hyper-parameter trials.

A trial table has trial_index, status, params (map of strings) and metrics (map
of doubles). An objective is a pair (metric name, minimise).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.cluster import join_dimension
from lexiform.operators.skyline import skyline

Objective = tuple[str, bool]

# Trials per bucket of a running computation.
BUCKET_TRIALS = 65_536

# The names under which a metric may be recorded, best first.
METRIC_ALIASES = {
    "accuracy": ["accuracy", "test_accuracy", "val_accuracy"],
    "f1_score": ["f1_score", "f1_macro", "test_f1_macro", "val_f1_macro"],
    "precision": ["precision", "test_precision", "val_precision"],
    "recall": ["recall", "test_recall", "val_recall"],
    "training_time": ["training_time", "train_time", "elapsed_time"],
    "prediction_time": ["prediction_time", "inference_time", "test_time"],
    "model_size": ["model_size", "n_parameters", "num_parameters"],
}


def numeric_metrics(results: Column | str) -> Column:
    """The entries of a string map that are numbers, as doubles."""
    parsed = F.transform_values(results, lambda _, value: value.try_cast("double"))
    return F.map_filter(parsed, lambda _, value: value.isNotNull())


def metric_value(name: str, metrics: Column | str = "metrics") -> Column:
    """A metric by its name or the first recorded alias; null if there is none."""
    names = METRIC_ALIASES.get(name, [name])
    return F.coalesce(*[F.try_element_at(metrics, F.lit(alias)) for alias in names])


def completed(trials: DataFrame) -> DataFrame:
    """Trials that ran to the end; only these take part in the analysis."""
    return trials.filter(F.col("status") == "completed")


def objective_values(trials: DataFrame, objectives: Sequence[Objective]) -> DataFrame:
    """One row per trial and objective: trial_index, objective, minimize, value."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("objective"),
                F.lit(minimize).alias("minimize"),
                metric_value(name).alias("value"),
            )
            for name, minimize in objectives
        ]
    )
    return (
        completed(trials)
        .select("trial_index", F.explode(entries).alias("_o"))
        .select("trial_index", "_o.objective", "_o.minimize", "_o.value")
    )


def signed(value: Column, minimize: Column) -> Column:
    """The value turned so that more is better."""
    return F.when(minimize, -value).otherwise(value)


def best_trial(trials: DataFrame, objectives: Sequence[Objective]) -> DataFrame:
    """The best trial of each objective, the first one on a tie.

    An aggregate, so each task sends one row per objective.
    """
    values = objective_values(trials, objectives).filter(F.col("value").isNotNull())
    key = F.struct(
        (-signed(F.col("value"), F.col("minimize"))).alias("key"),
        F.col("trial_index"),
        F.col("value"),
    )
    return (
        values.groupBy("objective", "minimize")
        .agg(F.min(key).alias("_best"))
        .select("objective", "minimize", "_best.trial_index", F.col("_best.value").alias("value"))
    )


def convergence(trials: DataFrame, objectives: Sequence[Objective]) -> DataFrame:
    """Best value so far of each objective in trial order: ..., value, best.

    A trial without the metric carries the last best. Trials are cut into
    buckets of consecutive indexes; a running best within a bucket is combined
    with the best of all earlier buckets, so no task holds more than a bucket.
    """
    values = objective_values(trials, objectives).withColumn(
        "_bucket", F.floor(F.col("trial_index") / F.lit(BUCKET_TRIALS))
    )
    score = signed(F.col("value"), F.col("minimize"))
    earlier = (
        Window.partitionBy("objective")
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    per_bucket = values.groupBy("objective", "_bucket").agg(F.max(score).alias("_top"))
    starts = per_bucket.select("objective", "_bucket", F.max("_top").over(earlier).alias("_start"))
    running = (
        Window.partitionBy("objective", "_bucket")
        .orderBy("trial_index")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    best = F.greatest(F.max(score).over(running), F.col("_start"))
    return (
        join_dimension(values, starts, ["objective", "_bucket"], "inner")
        .withColumn("_best", best)
        .select(
            "trial_index",
            "objective",
            "value",
            signed(F.col("_best"), F.col("minimize")).alias("best"),
        )
    )


def threshold_filter(
    trials: DataFrame, objectives: Sequence[Objective], thresholds: Mapping[str, float]
) -> DataFrame:
    """Trials within the bound of each objective; bounds on other metrics are ignored."""
    kept = completed(trials)
    for name, minimize in objectives:
        if name in thresholds:
            value, bound = metric_value(name), F.lit(float(thresholds[name]))
            kept = kept.filter(value <= bound if minimize else value >= bound)
    return kept


def pareto_frontier(
    trials: DataFrame, objectives: Sequence[Objective], mode: str = "strict"
) -> DataFrame:
    """Trials that no other trial dominates: trial_index and one column per objective.

    ``strict``: to dominate is to be better on every objective both have, so
    ties do not dominate. ``weak``: no worse on all and better on one.
    """
    if mode not in ("strict", "weak"):
        raise ValueError("mode must be strict or weak")
    names = [name for name, _ in objectives]
    values = completed(trials).select(
        "trial_index",
        *[F.nanvl(metric_value(name), F.lit(None).cast("double")).alias(name) for name in names],
    )
    turned = [-F.col(name) if minimize else F.col(name) for name, minimize in objectives]
    return skyline(values, turned, mode == "weak")


def recommend_configs(
    trials: DataFrame,
    objectives: Sequence[Objective],
    preferences: Mapping[str, float] | None = None,
) -> DataFrame:
    """Frontier trials, best score first: trial_index, score.

    A preference weighs a metric's value, or 1 / (1 + value) if it is to be
    minimised, over the weights of the metrics a trial has. Without preferences
    the frontier is returned as it is; with an empty frontier, the best trial of
    each objective.
    """
    frontier = pareto_frontier(trials, objectives)
    if frontier.isEmpty():
        best = best_trial(trials, objectives)
        return best.select("trial_index", F.lit(None).cast("double").alias("score"))
    if preferences is None:
        return frontier.select("trial_index", F.lit(None).cast("double").alias("score"))
    minimised = dict(objectives)
    total, weight = F.lit(0.0), F.lit(0.0)
    for name, wanted in preferences.items():
        value = metric_value(name)
        share = 1.0 / (1.0 + value) if minimised.get(name, False) else value
        total = total + F.coalesce(share * F.lit(float(wanted)), F.lit(0.0))
        weight = weight + F.when(value.isNotNull(), F.lit(float(wanted))).otherwise(0.0)
    members = frontier.select("trial_index")
    return (
        completed(trials)
        .join(members, "trial_index", "left_semi")
        .withColumn("_weight", weight)
        .filter(F.col("_weight") > 0)
        .select("trial_index", (total / F.col("_weight")).alias("score"))
        .orderBy(F.desc("score"), "trial_index")
    )


def trial_wide(
    trials: DataFrame,
    objectives: Sequence[Objective],
    params: Sequence[str],
    metrics: Sequence[str],
) -> DataFrame:
    """One column per parameter and metric, with is_pareto_optimal.

    The keys come from the search space, so no pivot is needed.
    """
    frontier = pareto_frontier(trials, objectives).select(
        "trial_index", F.lit(True).alias("_front")
    )
    done = completed(trials)
    return join_dimension(done, frontier, "trial_index").select(
        "trial_index",
        F.upper("status").alias("status"),
        F.coalesce("_front", F.lit(False)).alias("is_pareto_optimal"),
        *[F.try_element_at("params", F.lit(p)).alias(f"param_{p}") for p in params],
        *[F.try_element_at("metrics", F.lit(m)).alias(f"metric_{m}") for m in metrics],
    )


def trial_status(planned: DataFrame, recorded: DataFrame) -> DataFrame:
    """Status of each planned trial: completed, failed, or running if unrecorded."""
    marks = recorded.groupBy("trial_index").agg(F.min("status").alias("status"))
    return planned.select("trial_index").join(marks, "trial_index", "left").select(
        "trial_index", F.coalesce("status", F.lit("running")).alias("status")
    )


def search_summary(trials: DataFrame, objectives: Sequence[Objective]) -> DataFrame:
    """Totals, best value per objective and frontier members as rows: item, key, value."""
    rows = "string"
    totals = completed(trials).agg(F.count("*").alias("n")).select(
        F.lit("total_trials").alias("item"), F.lit(None).cast(rows).alias("key"),
        F.col("n").cast("double").alias("value"),
    )
    best = best_trial(trials, objectives).select(
        F.concat(F.lit("best_"), "objective").alias("item"),
        F.col("trial_index").cast(rows).alias("key"),
        F.col("value"),
    )
    frontier = pareto_frontier(trials, objectives).select(
        F.lit("frontier").alias("item"), F.col("trial_index").cast(rows).alias("key"),
        F.lit(None).cast("double").alias("value"),
    )
    return totals.unionByName(best).unionByName(frontier)
