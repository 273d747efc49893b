"""Hyper-parameter spaces, trial tables and trial runs."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.functions.keys import seeded_hash, unit_interval
from lexiform.operators.split import train_test
from lexiform.operators.trials import Objective, threshold_filter
from lexiform.plans.runs import classification_run, in_threads, make_extractor
from lexiform.plans.stages import TermFeatures
from lexiform.sources.trials_store import TRIAL_SCHEMA, kept_results, read_trials, save_trials

SQL_TYPES = {"int": "bigint", "float": "double", "string": "string"}


@dataclass(frozen=True)
class Parameter:
    """A range (lower, upper, log), a choice (values) or a fixed value."""

    kind: str
    type: str = "float"
    lower: float | None = None
    upper: float | None = None
    log: bool = False
    values: Sequence[Any] | None = None
    ordered: bool = False
    value: Any = None

    def check(self, name: str) -> None:
        """Raise if the domain is incomplete."""
        if self.type not in SQL_TYPES:
            raise ValueError(f"{name}: unknown type {self.type}")
        if self.kind == "range":
            if self.lower is None or self.upper is None:
                raise ValueError(f"{name}: a range needs lower and upper")
            if self.lower > self.upper or (self.log and self.lower <= 0):
                raise ValueError(f"{name}: the range is empty or not positive")
        elif self.kind == "choice":
            if not self.values:
                raise ValueError(f"{name}: a choice needs values")
        elif self.kind == "fixed":
            if self.value is None:
                raise ValueError(f"{name}: a fixed parameter needs a value")
        else:
            raise ValueError(f"{name}: unknown kind {self.kind}")

    def sample(self, u: Column) -> Column:
        """The value at a point of [0, 1)."""
        sql_type = SQL_TYPES[self.type]
        if self.kind == "fixed":
            return F.lit(self.value).cast(sql_type)
        if self.kind == "choice":
            place = F.floor(u * F.lit(len(self.values))).cast("int")
            return F.get(F.array(*[F.lit(v) for v in self.values]), place).cast(sql_type)
        low, high = float(self.lower), float(self.upper)
        if self.type == "int" and not self.log:
            return F.floor(F.lit(low) + u * F.lit(high - low + 1)).cast(sql_type)
        if self.log:
            spread = F.exp(F.lit(math.log(low)) + u * F.lit(math.log(high) - math.log(low)))
        else:
            spread = F.lit(low) + u * F.lit(high - low)
        return F.round(spread).cast(sql_type) if self.type == "int" else spread

    def points(self, n: int) -> list:
        """All values, or ``n`` evenly spaced ones of a range."""
        if self.kind == "fixed":
            return [self.value]
        if self.kind == "choice":
            return list(self.values)
        low, high = float(self.lower), float(self.upper)
        if self.log:
            low, high = math.log(low), math.log(high)
        steps = [low + (high - low) * i / max(1, n - 1) for i in range(n)]
        steps = [math.exp(s) for s in steps] if self.log else steps
        return sorted({round(s) for s in steps}) if self.type == "int" else steps


@dataclass
class SearchSpace:
    """Parameters of the extractor, the model and the training."""

    extractor: dict[str, Parameter] = field(default_factory=dict)
    model: dict[str, Parameter] = field(default_factory=dict)
    training: dict[str, Parameter] = field(default_factory=dict)

    def parameters(self) -> dict[str, Parameter]:
        """All parameters under their prefixed names, checked."""
        named = {}
        for part in ("extractor", "model", "training"):
            for name, parameter in getattr(self, part).items():
                parameter.check(f"{part}_{name}")
                named[f"{part}_{name}"] = parameter
        return named


def sample_trials(trials: DataFrame, space: SearchSpace, seed: int = 42) -> DataFrame:
    """Add one drawn value per parameter to each trial_index.

    The draw hashes trial, parameter and seed, so a trial is the same however
    many are planned and wherever it is computed.
    """
    drawn = [
        parameter.sample(unit_interval(seeded_hash("trial_index", f"{name}:{seed}"))).alias(name)
        for name, parameter in space.parameters().items()
    ]
    return trials.select("trial_index", *drawn)


def grid_trials(spark: SparkSession, space: SearchSpace, points: int = 3) -> DataFrame:
    """Every combination of the parameters' values as numbered trials.

    A trial's values are the digits of its index, so nothing is joined.
    """
    columns, stride = [], 1
    for name, parameter in space.parameters().items():
        values = parameter.points(points)
        place = (F.floor(F.col("trial_index") / F.lit(stride)) % F.lit(len(values))).cast("int")
        choices = F.array(*[F.lit(v) for v in values])
        columns.append(F.get(choices, place).cast(SQL_TYPES[parameter.type]).alias(name))
        stride *= len(values)
    return spark.range(stride).withColumnRenamed("id", "trial_index").select(
        "trial_index", *columns
    )


# The default search spaces and objectives.
_TERMS = {
    "max_features": Parameter("choice", "int", values=[1000, 5000, 10000, 20000, 50000], ordered=True),
    "min_df": Parameter("range", "int", 1, 10),
    "max_df": Parameter("range", "float", 0.5, 0.95),
}
EXTRACTOR_SPACES = {
    "tfidf_vectorizer": _TERMS,
    "count_vectorizer": _TERMS,
    "batched_embeddings": {
        "size": Parameter("choice", "int", values=[64, 128], ordered=True),
        "batch_size": Parameter("choice", "int", values=[50, 100, 200], ordered=True),
    },
}
MODEL_SPACES = {
    "logistic_regression": {
        "C": Parameter("range", "float", 0.001, 10.0, log=True),
        "max_iter": Parameter("choice", "int", values=[100, 200, 500, 1000], ordered=True),
    },
    "knn_classifier": {
        "n_neighbors": Parameter("range", "int", 3, 20),
        "weights": Parameter("choice", "string", values=["uniform", "distance"]),
    },
}
DEFAULT_OBJECTIVES: list[Objective] = [("accuracy", False), ("training_time", True)]
DEFAULT_THRESHOLDS = {"accuracy": 0.80, "training_time": 300.0}


def default_space(extractor: str, model: str) -> SearchSpace:
    """The default domains of an extractor and a model."""
    return SearchSpace(
        dict(EXTRACTOR_SPACES.get(extractor, {})), dict(MODEL_SPACES.get(model, {}))
    )


def _part(values: dict, prefix: str) -> dict:
    return {k[len(prefix) :]: v for k, v in values.items() if k.startswith(prefix)}


def run_trials(
    data: DataFrame,
    trials: DataFrame,
    path: str,
    extractor: str = "tfidf_vectorizer",
    model: str = "logistic_regression",
    extractor_params: dict | None = None,
    model_params: dict | None = None,
    use_class_weights: bool = True,
    parallel: int = 2,
    metrics: Sequence[str] = (),
) -> DataFrame:
    """Run each planned trial and record it below ``path``; returns the trial table.

    The split is made and kept once. Term statistics of the training side are
    counted once as well and serve every trial's bounds. ``metrics`` names
    registered metrics that are recorded besides the usual ones, and may be
    objectives. A trial that fails is recorded with its error and does not stop
    the others.
    """
    spark = data.sparkSession
    train, test = (part.persist() for part in train_test(data))
    statistics = None
    features = make_extractor(extractor, **(extractor_params or {}))
    if isinstance(features, TermFeatures):
        statistics = features.term_statistics(train).persist(), train.count()

    def run(trial):
        values = trial.asDict()
        index = values.pop("trial_index")
        started = time.time()
        head = (index, str(uuid.uuid4()), {k: str(v) for k, v in values.items()})
        try:
            result = classification_run(
                (train, test),
                extractor,
                model,
                {**(extractor_params or {}), **_part(values, "extractor_")},
                {**(model_params or {}), **_part(values, "model_")},
                use_class_weights,
                statistics=statistics,
                metrics=metrics,
            )
            seconds = time.time() - started
            scores = {**result.scores, "training_time": seconds}
            record = (*head, kept_results(scores, metrics), seconds, None, "completed")
            result.predictions.unpersist()
        except Exception as problem:
            record = (*head, None, time.time() - started, str(problem), "failed")
        one = spark.createDataFrame([record], f"{TRIAL_SCHEMA}, status string")
        save_trials(one.coalesce(1), path, f"trial-{index}")

    in_threads(spark, run, trials.orderBy("trial_index").collect(), parallel)
    if statistics is not None:
        statistics[0].unpersist()
    train.unpersist()
    test.unpersist()
    return read_trials(spark, path)


def hyperparameter_search(
    data: DataFrame,
    path: str,
    extractor: str = "tfidf_vectorizer",
    model: str = "logistic_regression",
    space: SearchSpace | None = None,
    total_trials: int = 20,
    parallel: int = 2,
    seed: int = 42,
    **options,
) -> DataFrame:
    """Draw trials from a space and run them."""
    planned = data.sparkSession.range(total_trials).withColumnRenamed("id", "trial_index")
    drawn = sample_trials(planned, space or default_space(extractor, model), seed)
    return run_trials(data, drawn, path, extractor, model, parallel=parallel, **options)


def acceptable_trials(trials: DataFrame) -> DataFrame:
    """Trials within the default thresholds."""
    return threshold_filter(trials, DEFAULT_OBJECTIVES, DEFAULT_THRESHOLDS)
