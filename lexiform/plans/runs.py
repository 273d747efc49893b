"""End-to-end classification runs, scoring, saving and experiment suites."""

from __future__ import annotations

import json
import math
import time
import warnings
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiform import sources
from lexiform.cluster import join_dimension, local_table, settled
from lexiform.functions.vectors import decide_class
from lexiform.operators.metrics import (
    classification_report,
    confusion_matrix,
    f1_scores,
    metric_values,
)
from lexiform.operators.profile import class_name, feature_info
from lexiform.operators.split import train_test
from lexiform.operators.weights import class_weights
from lexiform.plans.models import DECISIONS, make_model, model_info
from lexiform.plans.stages import (
    NumericColumns,
    Projection,
    TermFeatures,
    TextEncoder,
    WordVectors,
)

VERSION = "1"

# Trainers pass over their rows many times; a task should hold at least so many bytes of them.
TASK_BYTES = 32 << 20


# Extractors by name: functions of their parameters that give a stage with the features.
EXTRACTORS: dict[str, Callable] = {}

# Parameters under the names of the stages.
_RENAMED = {
    "max_features": "maxFeatures", "min_df": "minDF", "max_df": "maxDF",
    "stop_words": "stopWords", "use_idf": "useIdf", "smooth_idf": "smoothIdf",
    "sublinear_tf": "sublinearTf", "vector_size": "vectorSize", "min_count": "minCount",
    "batch_size": "batchSize",
}


def register_extractor(kind: str, make: Callable) -> None:
    """Make an extractor known to runs, suites and searches under this name.

    ``make(**params)`` returns an estimator or transformer whose result has ``features``.
    """
    EXTRACTORS[kind] = make


def make_extractor(kind: str, **params):
    """A feature extractor by name."""
    if kind not in EXTRACTORS:
        raise ValueError(f"unknown extractor {kind!r}, expected one of {sorted(EXTRACTORS)}")
    return EXTRACTORS[kind](**params)


def _stage(kind, **fixed):
    """A stage under its own parameters' names or the common ones."""

    def make(**params):
        return kind(**fixed, **{_RENAMED.get(name, name): value for name, value in params.items()})

    return make


register_extractor("count_vectorizer", _stage(TermFeatures))
register_extractor("tfidf_vectorizer", _stage(TermFeatures, tfidf=True))
register_extractor("word2vec", _stage(WordVectors))
register_extractor("sentence_embeddings", _stage(TextEncoder))
register_extractor("batched_embeddings", lambda batch_size=100, **params: _stage(TextEncoder)(
    batch_size=batch_size, **params
))
register_extractor("column", _stage(Projection, outputCol="features"))
register_extractor("columns", _stage(NumericColumns, outputCol="features"))


def extractor_info(kind: str, fitted) -> dict:
    """What a fitted extractor produces."""
    for stage in getattr(fitted, "stages", []):
        if isinstance(stage, CountVectorizerModel) and kind != "word2vec":
            return feature_info(kind, vocab_size=len(stage.vocabulary))
        if hasattr(stage, "getVectorSize"):
            return feature_info(kind, vector_size=stage.getVectorSize())
        if hasattr(stage, "factory"):
            get = stage.getOrDefault
            return feature_info(kind, encoder=get("factory"), embedding_dim=get("size"))
    return feature_info(kind)


@dataclass
class FittedRun:
    """A fitted classifier with the classes it knows."""

    model: PipelineModel
    classes: DataFrame  # label, target, target_name
    decision: str = "label"
    settings: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """Add prediction (a class code), prediction_name and, if known, probability.

        Row-wise for all models but nearest neighbours, so it also serves streams.
        """
        scored = self.model.transform(df).drop("features", "rawPrediction")
        codes = self.classes.select(
            F.col("label").alias("_label"),
            F.col("target").alias("_target"),
            F.col("target_name").alias("prediction_name"),
        )
        marked = scored.withColumn("_label", decide_class("prediction", self.decision))
        return (
            join_dimension(marked, codes, "_label")
            .withColumn("prediction", F.col("_target"))
            .drop("_label", "_target")
        )


@dataclass
class RunResult:
    """What a run leaves: the fitted run, its test predictions and its scores."""

    fitted: FittedRun
    predictions: DataFrame
    scores: dict

    @property
    def metrics(self) -> DataFrame:
        """The scores as one row."""
        spark = self.predictions.sparkSession
        numbers = {k: float(v) for k, v in self.scores.items() if isinstance(v, (int, float))}
        return spark.createDataFrame([tuple(numbers.values())], ", ".join(f"{k} double" for k in numbers))


def classification_run(
    data: DataFrame | tuple[DataFrame, DataFrame],
    extractor: str = "count_vectorizer",
    model: str = "logistic_regression",
    extractor_params: dict | None = None,
    model_params: dict | None = None,
    use_class_weights: bool = False,
    test_size: float = 0.2,
    seed: int = 42,
    identifier: str = "doc_id",
    names: DataFrame | None = None,
    save_path: str | None = None,
    statistics: tuple[DataFrame, int] | None = None,
    cache_split: bool = True,
    task_bytes: int | None = TASK_BYTES,
    metrics: Iterable[str] = (),
) -> RunResult:
    """Split, extract features, fit, predict the test side and score it.

    ``data`` has doc_id, text and target, or is a pair of train and test frames.
    Class codes may be any integers. ``statistics`` are term statistics of the
    training side, to be shared between runs on the same split. The texts are
    read once for the classes, once for the features and once to apply them.
    The split is cached for that, on disk where memory ends; ``cache_split=False``
    reads the source again instead, which is cheaper if it is a plain scan.
    Cached training rows are gathered into partitions of ``task_bytes``; None
    leaves their partitions as they are. ``metrics`` names registered metrics
    that are scored besides the usual ones. The predictions stay cached; release
    them with ``result.predictions.unpersist()``.
    """
    started = time.time()
    kept: list[DataFrame] = []
    try:
        return _run(
            data, extractor, model, extractor_params, model_params, use_class_weights, test_size,
            seed, identifier, names, save_path, statistics, cache_split, task_bytes, metrics, started, kept,
        )
    finally:
        for frame in kept:
            frame.unpersist()


def _run(
    data, extractor, model, extractor_params, model_params, use_class_weights, test_size, seed,
    identifier, names, save_path, statistics, cache_split, task_bytes, metrics, started, kept,
) -> RunResult:
    """The steps of classification_run; ``kept`` collects the frames to be released."""
    if isinstance(data, tuple):
        train, test = data
    else:
        train, test = train_test(
            data, identifier=identifier, test_size=test_size, seed=seed
        )
    own_split = cache_split and not isinstance(data, tuple)
    if own_split:
        train, test = train.persist(), test.persist()
        kept += [train, test]
    codes, _ = settled(class_weights(train))
    rank = F.row_number().over(Window.orderBy("target")) - 1
    codes = codes.withColumn("label", rank.cast("int"))
    if names is None:
        codes = codes.withColumn("target_name", class_name())
    else:
        codes = codes.join(names, "target", "left")
    rows = codes.orderBy("label").collect()
    n_train = sum(row["n"] for row in rows)
    classes = local_table(train.sparkSession, rows, codes.schema)
    weight = "weight" if use_class_weights and model != "gbt_regressor" else ""
    if use_class_weights and not weight:
        warnings.warn("class weights are ignored by a regressor", stacklevel=2)
    known = classes.select("target", F.col("label").cast("double").alias("label"), "weight")
    training = join_dimension(train, known, "target", "inner")
    features = make_extractor(extractor, **(extractor_params or {}))
    if isinstance(features, TermFeatures):
        features.statistics = statistics or (features.term_statistics(training), n_train)
    fitted_features = features.fit(training) if hasattr(features, "fit") else features
    columns = [identifier, "features", "label", *([weight] if weight else [])]
    prepared = fitted_features.transform(training).select(*columns).persist()
    trainer = make_model(model, len(rows), weight, identifier, **(model_params or {}))
    kept.append(prepared)
    rows_to_fit = prepared
    if task_bytes:
        prepared.count()  # the cached size is known afterwards
        held = prepared._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        rows_to_fit = prepared.coalesce(max(1, math.ceil(held / task_bytes)))
    fitted_model = trainer.fit(rows_to_fit)
    training_time = time.time() - started
    fitted = FittedRun(
        PipelineModel([fitted_features, fitted_model]),
        classes.select("label", "target", "target_name"),
        DECISIONS.get(model, "label"),
        {
            "extractor": extractor,
            "model": model,
            "feature_info": extractor_info(extractor, fitted_features),
            "model_info": model_info(model, fitted_model, [row["target"] for row in rows]),
        },
    )
    began = time.time()
    predictions = fitted.predict(test)
    found = predictions.select(*[c for c in predictions.columns if c != "text"]).persist()
    try:
        scores = f1_scores(found).first().asDict()
        scores.update(metric_values(ranked_rows(found, classes), metrics))
        if save_path:
            save_run(fitted, save_path)
    except BaseException:
        found.unpersist()
        raise
    prediction_time = time.time() - began
    scores.update(
        n_train=n_train,
        n_test=scores.pop("support"),
        training_time=training_time,
        prediction_time=prediction_time,
        model_size=fitted.settings["model_info"]["model_size"],
        target_names=json.dumps([row["target_name"] for row in rows]),
    )
    return RunResult(fitted, found, scores)


def ranked_rows(predictions: DataFrame, classes: DataFrame) -> DataFrame:
    """Predictions as metrics read them: target, prediction, label, chances."""
    chances = F.lit(None).cast("array<double>")
    if "probability" in predictions.columns:
        chances = vector_to_array("probability")
    rows = predictions.select("target", "prediction", chances.alias("chances"))
    return join_dimension(rows, classes.select("target", "label"), "target")


def score_text(fitted: FittedRun, df: DataFrame) -> DataFrame:
    """Class name and probabilities of new texts."""
    scored = fitted.predict(df)
    kept = [c for c in ("prediction", "prediction_name", "probability") if c in scored.columns]
    return scored.select(*[c for c in df.columns if c != "target"], *kept)


def run_name(extractor: str, model: str, now: datetime | None = None) -> str:
    """Default name of a saved run."""
    return f"pipeline_{extractor}_{model}_{(now or datetime.now()):%Y%m%d_%H%M%S}"


def save_run(fitted: FittedRun, path: str) -> None:
    """Write model, classes and settings below a path on any file system."""
    for stage in fitted.model.stages:
        if not hasattr(stage, "write"):
            raise ValueError(f"{type(stage).__name__} cannot be saved")
    fitted.model.write().overwrite().save(f"{path}/model")
    fitted.classes.coalesce(1).write.mode("overwrite").parquet(f"{path}/classes")
    metadata = {
        "version": VERSION,
        "n_steps": len(fitted.model.stages),
        "steps": [type(stage).__name__ for stage in fitted.model.stages],
        "decision": fitted.decision,
        "settings": fitted.settings,
    }
    spark = fitted.classes.sparkSession
    spark.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/metadata")


def load_run(spark: SparkSession, path: str) -> FittedRun:
    """Read what save_run wrote."""
    metadata = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return FittedRun(
        PipelineModel.load(f"{path}/model"),
        spark.read.parquet(f"{path}/classes"),
        metadata["decision"],
        metadata["settings"],
    )


EXPERIMENT_SCHEMA = """
    experiment_id int, description string,
    configuration struct<extractor: string, model: string, use_class_weights: boolean,
        extractor_params: map<string,string>, model_params: map<string,string>>,
    feature_info string, model_info string,
    performance struct<accuracy: double, f1_macro: double, f1_weighted: double,
        confusion_matrix: array<array<bigint>>,
        classification_report: map<string, map<string, double>>>,
    execution_time_seconds double, status string, error string, recorded_at string
"""


def _strings(params: dict | None) -> dict[str, str]:
    return {k: str(v) for k, v in (params or {}).items()}


def in_threads(spark: SparkSession, work, items: Sequence, parallel: int) -> list:
    """Apply work to items, some at a time; Spark shares the cluster among them."""
    if parallel <= 1:
        return [work(item) for item in items]
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def experiment_suite(
    spark: SparkSession,
    configs: Sequence[dict],
    data: DataFrame | None = None,
    parallel: int = 1,
) -> DataFrame:
    """Run each configuration and record its scores or its error.

    A configuration may name extractor, model, extractor_params, model_params,
    use_class_weights, description, and source with loader_params; without a
    source the shared ``data`` is used, split once for all.
    """
    shared = tuple(part.persist() for part in train_test(data)) if data is not None else None

    def run(numbered):
        number, config = numbered
        started = time.time()
        extractor = config.get("extractor", "count_vectorizer")
        model = config.get("model", "logistic_regression")
        configuration = (
            extractor, model, bool(config.get("use_class_weights", False)),
            _strings(config.get("extractor_params")), _strings(config.get("model_params")),
        )
        head = (number, config.get("description", f"{extractor}, {model}"), configuration)
        try:
            if config.get("source"):
                rows = sources.load(spark, config["source"], **config.get("loader_params", {}))
            else:
                rows = shared
            if rows is None:
                raise ValueError("no source and no shared data")
            result = classification_run(
                rows, extractor, model, config.get("extractor_params"),
                config.get("model_params"), bool(config.get("use_class_weights", False)),
            )
            cells = confusion_matrix(result.predictions).orderBy("y_true", "y_pred").collect()
            matrix = {}
            for cell in cells:
                matrix.setdefault(cell["y_true"], []).append(cell["n"])
            report = {
                row["label"]: {
                    "precision": row["precision"], "recall": row["recall"],
                    "f1-score": row["f1"], "support": float(row["support"]),
                }
                for row in classification_report(result.predictions).collect()
            }
            scores = result.scores
            performance = (
                scores["accuracy"], scores["f1_macro"], scores["f1_weighted"],
                list(matrix.values()), report,
            )
            result.predictions.unpersist()
            settings = result.fitted.settings
            tail = (
                json.dumps(settings["feature_info"]), json.dumps(settings["model_info"]),
                performance, time.time() - started, "success", None,
            )
        except Exception as problem:
            tail = (None, None, None, time.time() - started, "failed", str(problem))
        return (*head, *tail, datetime.now().isoformat())

    try:
        records = in_threads(spark, run, list(enumerate(configs, 1)), parallel)
    finally:
        for part in shared or ():
            part.unpersist()
    return spark.createDataFrame(records, EXPERIMENT_SCHEMA)


def experiment_summary(records: DataFrame) -> DataFrame:
    """Per status: number of experiments, mean and best accuracy and macro F1."""
    return records.groupBy("status").agg(
        F.count("*").alias("n"),
        F.avg("accuracy").alias("mean_accuracy"),
        F.max("accuracy").alias("best_accuracy"),
        F.max("f1_macro").alias("best_f1_macro"),
        F.count("error").alias("n_errors"),
    )


def experiment_outcomes(records: DataFrame) -> DataFrame:
    """One line per experiment: scores of the successes, errors of the failures."""
    return records.select(
        "experiment_id",
        "description",
        "status",
        F.col("performance.accuracy").alias("accuracy"),
        F.col("performance.f1_macro").alias("f1_macro"),
        "error",
    )
