"""Trial and experiment records as JSON datasets on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.operators.trials import (
    Objective,
    best_trial,
    completed,
    convergence,
    numeric_metrics,
    pareto_frontier,
)

TRIAL_SCHEMA = (
    "trial_index bigint, trial_id string, hyperparameters map<string,string>, "
    "results map<string,string>, training_time double, error string"
)

# The results of a run that a trial record keeps.
KEPT_RESULTS = ["accuracy", "f1_macro", "f1_weighted", "training_time", "target_names"]
MEASURED_RESULTS = [
    "precision_macro", "recall_macro", "prediction_time", "model_size", "n_train", "n_test",
]


def kept_results(results: dict, metrics: Sequence[str] = ()) -> dict[str, str]:
    """The recordable part of a run's results and the named metrics, as strings."""
    kept = {}
    for name in [*KEPT_RESULTS, *MEASURED_RESULTS, *metrics]:
        if results.get(name) is not None:
            kept[name] = str(results[name])
    return kept


def save_trials(records: DataFrame, path: str, batch: str | None = None) -> None:
    """Add trial records, one folder per batch and status.

    Every batch has its own folder, so that concurrent writers do not commit
    each other's files.
    """
    folder = f"{path}/batch={batch or uuid.uuid4().hex}"
    records.write.mode("overwrite").partitionBy("status").json(folder)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """All trial records below a folder as a trial table, numeric results as metrics."""
    records = spark.read.schema(f"{TRIAL_SCHEMA}, status string").json(path)
    return records.select(
        "trial_index",
        "trial_id",
        F.col("status"),
        F.col("hyperparameters").alias("params"),
        numeric_metrics("results").alias("metrics"),
        "training_time",
        "error",
    )


def trial_record(spark: SparkSession, path: str, trial_index: int) -> dict:
    """One trial's record, or the status running if there is none."""
    row = read_trials(spark, path).filter(F.col("trial_index") == trial_index).first()
    return row.asDict(recursive=True) if row else {"status": "running"}


def save_experiments(records: DataFrame, path: str) -> None:
    """Write experiment records, one JSON object per line."""
    records.write.mode("overwrite").json(path)


def export_search(
    trials: DataFrame, objectives: Sequence[Objective], path: str, name: str = "search"
) -> None:
    """Write a finished search: totals, best trials, running bests and all trials.

    Each part is a folder of JSON lines below ``path``, so that none has to fit
    into one record.
    """
    frontier = pareto_frontier(trials, objectives)
    best = best_trial(trials, objectives)
    totals = completed(trials).agg(F.count("*").alias("total_trials")).select(
        F.lit(name).alias("experiment_name"),
        "total_trials",
        F.lit(frontier.count()).alias("pareto_frontier_size"),
    )
    totals.write.mode("overwrite").json(f"{path}/summary")
    best.write.mode("overwrite").json(f"{path}/best_single_objective")
    convergence(trials, objectives).write.mode("overwrite").json(f"{path}/convergence")
    members = frontier.select("trial_index", F.lit(True).alias("is_pareto_optimal"))
    completed(trials).join(members, "trial_index", "left").fillna(
        False, ["is_pareto_optimal"]
    ).write.mode("overwrite").json(f"{path}/trials")
