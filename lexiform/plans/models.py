"""Classifiers and regressors as Spark ML estimators.

All read ``features`` and ``label`` (codes from 0) and, if ``weightCol`` is set,
row weights. Classifiers add ``prediction`` and ``probability``.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsWritable,
    MLReadable,
    MLWritable,
)
from pyspark.sql import functions as F

from lexiform.cluster import checkpointed
from lexiform.functions.vectors import argmax, as_array
from lexiform.operators import boosting
from lexiform.operators.knn import k_nearest, knn_predict, knn_proba
from lexiform.operators.split import stratified_split
from lexiform.operators.weights import with_copies
from lexiform.plans.stages import (
    DropColumns,
    PopulationScaler,
    TableReader,
    TableWriter,
)


# Networks are trained on dense rows; a task should hold at most about so many bytes of them.
DENSE_BYTES = 64 << 20


def _param(name: str, kind=None) -> Param:
    return Param(Params._dummy(), name, name, kind or TypeConverters.identity)


class _Trainer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    weightCol = _param("weightCol", TypeConverters.toString)

    def _weight(self) -> str:
        return self.getOrDefault("weightCol")


class LogisticTrainer(_Trainer):
    """L2 logistic regression with the penalty given as its inverse, C."""

    C = _param("C", TypeConverters.toFloat)
    maxIter = _param("maxIter", TypeConverters.toInt)
    tol = _param("tol", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, C=1.0, maxIter=1000, tol=1e-4, weightCol=""):
        super().__init__()
        self._set(C=C, maxIter=maxIter, tol=tol, weightCol=weightCol)

    def _fit(self, dataset):
        weight = F.col(self._weight()) if self._weight() else F.lit(1.0)
        total = dataset.agg(F.sum(weight)).first()[0]
        trainer = LogisticRegression(
            maxIter=self.getOrDefault("maxIter"),
            tol=self.getOrDefault("tol"),
            regParam=1.0 / (self.getOrDefault("C") * total),
            elasticNetParam=0.0,
            standardization=False,
        )
        if self._weight():
            trainer.setWeightCol(self._weight())
        return trainer.fit(dataset)


class BoostedTreesTrainer(_Trainer):
    """Boosted trees of one loss: logistic for two classes, softmax for more, squared for numbers
    (``classes`` 0). ``extra`` holds further settings of boosting.Settings by name."""

    n_estimators = _param("n_estimators", TypeConverters.toInt)
    max_depth = _param("max_depth", TypeConverters.toInt)
    learning_rate = _param("learning_rate", TypeConverters.toFloat)
    seed = _param("seed", TypeConverters.toInt)
    classes = _param("classes", TypeConverters.toInt)
    extra = _param("extra", TypeConverters.toString)

    @keyword_only
    def __init__(self, n_estimators=100, max_depth=6, learning_rate=0.1, seed=42, classes=2,
                 extra="{}", weightCol=""):
        super().__init__()
        self._set(n_estimators=n_estimators, max_depth=max_depth, learning_rate=learning_rate,
                  seed=seed, classes=classes, extra=extra, weightCol=weightCol)

    def _fit(self, dataset):
        get = self.getOrDefault
        classes = get("classes")
        objective = "squared" if classes == 0 else "logistic" if classes <= 2 else "softmax"
        settings = boosting.Settings(
            get("n_estimators"), get("max_depth"), get("learning_rate"), seed=get("seed"),
            **json.loads(get("extra")),
        )
        outputs = classes if objective == "softmax" else 1
        fitted = boosting.fit(dataset, outputs, objective, settings, weight=self._weight())
        return BoostedModel(trees=fitted.to_json(), outputs=outputs)


class BoostedModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted boosted trees: probability and prediction, or a number as prediction."""

    trees = _param("trees", TypeConverters.toString)
    outputs = _param("outputs", TypeConverters.toInt)

    @keyword_only
    def __init__(self, trees="", outputs=1):
        super().__init__()
        self._set(trees=trees, outputs=outputs)

    @property
    def fitted(self) -> boosting.Boosted:
        return boosting.Boosted.from_json(self.getOrDefault("trees"))

    def _transform(self, dataset):
        outputs, model = self.getOrDefault("outputs"), self.fitted
        shared = dataset.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf("array<double>")
        def score(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
            held = shared.value
            for batch in rows:
                x = np.array(batch.tolist(), float).reshape(len(batch), -1)
                made = held.margins(x, outputs)
                if held.objective != "squared":
                    made = boosting.chances(made, held.objective)
                yield pd.Series(list(made))

        scores = score.asNondeterministic()(as_array(dataset, "features"))
        scored = dataset.withColumn("_scores", scores)
        if model.objective == "squared":
            return scored.withColumn("prediction", F.get("_scores", 0)).drop("_scores")
        return scored.withColumns(
            {"probability": array_to_vector("_scores"), "prediction": argmax("_scores").cast("double")}
        ).drop("_scores")


class NetworkTrainer(_Trainer):
    """Feed-forward network on standardised features.

    ``patience`` above 0 stops early: training goes on in blocks of iterations
    from the last weights, and the block with the lowest loss on a stratified
    validation share wins. Row weights become copies of rows. A ``learning_rate``
    above 0 trains by gradient descent with that step, otherwise l-bfgs finds
    its own.
    """

    hidden = _param("hidden", TypeConverters.toListInt)
    epochs = _param("epochs", TypeConverters.toInt)
    block = _param("block", TypeConverters.toInt)
    learning_rate = _param("learning_rate", TypeConverters.toFloat)
    validation = _param("validation", TypeConverters.toFloat)
    patience = _param("patience", TypeConverters.toInt)
    seed = _param("seed", TypeConverters.toInt)
    classes = _param("classes", TypeConverters.toInt)
    identifier = _param("identifier", TypeConverters.toString)

    @keyword_only
    def __init__(self, hidden=(128, 128, 64), epochs=100, block=10, learning_rate=0.0,
                 validation=0.2, patience=0, seed=42, classes=2, identifier="doc_id",
                 weightCol=""):
        super().__init__()
        self._set(hidden=list(hidden), epochs=epochs, block=block, learning_rate=learning_rate,
                  validation=validation, patience=patience, seed=seed, classes=classes,
                  identifier=identifier, weightCol=weightCol)

    def _fit(self, dataset):
        get = self.getOrDefault
        key = get("identifier")
        scaler = PopulationScaler(inputCol="features", outputCol="_scaled").fit(dataset)
        extra = [self._weight()] if self._weight() else []
        rows = scaler.transform(dataset).select(key, "_scaled", "label", *extra).persist()
        try:
            best = self._trained(rows, key)
        finally:
            rows.unpersist()
        return PipelineModel([scaler, best, DropColumns(columns=["_scaled"])])

    def _trained(self, rows, key):
        get = self.getOrDefault
        width = rows.select(F.size(as_array(rows, "_scaled"))).first()[0]

        def trainer(iterations, weights=None):
            network = MultilayerPerceptronClassifier(
                layers=[width, *get("hidden"), get("classes")], maxIter=iterations,
                seed=get("seed"), featuresCol="_scaled",
            )
            if get("learning_rate") > 0:
                network.setSolver("gd").setStepSize(get("learning_rate"))
            return network.setInitialWeights(weights) if weights is not None else network

        def weighed(frame):
            frame = with_copies(frame, self._weight(), key) if self._weight() else frame
            parts = math.ceil(frame.count() * width * 8 / DENSE_BYTES)
            cores = frame.sparkSession.sparkContext.defaultParallelism
            return frame.repartition(max(parts, cores)) if parts > 1 else frame

        if get("patience"):
            marked = stratified_split(rows, key, "label", get("validation"), get("seed"))
            train = weighed(marked.filter("split = 'train'")).persist()
            held_out = marked.filter("split = 'test'").persist()
            best, lowest, weights, waited, done = None, None, None, 0, 0
            try:
                while done < get("epochs") and waited < get("patience"):
                    model = trainer(min(get("block"), get("epochs") - done), weights).fit(train)
                    weights, done = model.weights, done + get("block")
                    loss = self._loss(model, held_out)
                    if lowest is None or loss < lowest:
                        best, lowest, waited = model, loss, 0
                    else:
                        waited += get("block")
            finally:
                train.unpersist()
                held_out.unpersist()
            return best
        return trainer(get("epochs")).fit(weighed(rows))

    def _loss(self, model, rows):
        chosen = F.get(vector_to_array("probability"), F.col("label").cast("int"))
        weight = F.col(self._weight()) if self._weight() else F.lit(1.0)
        loss = -F.log(F.greatest(chosen, F.lit(1e-15))) * weight
        return model.transform(rows).agg(F.sum(loss) / F.sum(weight)).first()[0]


class NeighbourTrainer(_Trainer):
    """k nearest neighbours. Class weights switch the vote to distance weighting."""

    n_neighbors = _param("n_neighbors", TypeConverters.toInt)
    weights = _param("weights", TypeConverters.toString)
    metric = _param("metric", TypeConverters.toString)
    p = _param("p", TypeConverters.toFloat)
    identifier = _param("identifier", TypeConverters.toString)

    @keyword_only
    def __init__(self, n_neighbors=5, weights="uniform", metric="minkowski", p=2.0,
                 identifier="doc_id", weightCol=""):
        super().__init__()
        self._set(n_neighbors=n_neighbors, weights=weights, metric=metric, p=p,
                  identifier=identifier, weightCol=weightCol)

    def _fit(self, dataset):
        get = self.getOrDefault
        model = NeighbourModel(
            n_neighbors=get("n_neighbors"), metric=get("metric"), p=get("p"),
            weights="distance" if self._weight() else get("weights"),
            identifier=get("identifier"),
            classes=[int(row[0]) for row in dataset.select("label").distinct().collect()],
        )
        # Written once, so that scoring does not compute the features again.
        model.table = checkpointed(dataset.select(get("identifier"), "features", "label"))
        return model


class NeighbourModel(Model, MLReadable, MLWritable):
    """The training rows and how they vote. Needs a row id; batch only."""

    n_neighbors = NeighbourTrainer.n_neighbors
    weights = NeighbourTrainer.weights
    metric = NeighbourTrainer.metric
    p = NeighbourTrainer.p
    identifier = NeighbourTrainer.identifier
    classes = _param("classes", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, n_neighbors=5, weights="uniform", metric="minkowski", p=2.0,
                 identifier="doc_id", classes=()):
        super().__init__()
        self._set(n_neighbors=n_neighbors, weights=weights, metric=metric, p=p,
                  identifier=identifier, classes=sorted(classes))
        self.table = None

    def write(self):
        return TableWriter(self)

    @classmethod
    def read(cls):
        return TableReader(cls)

    def _transform(self, dataset):
        get = self.getOrDefault
        key, codes = get("identifier"), get("classes")
        near = k_nearest(
            dataset, self.table, get("n_neighbors"), get("p"), get("metric"), key, target="label"
        )
        place = list(range(max(codes) + 1))
        result = knn_predict(near, get("weights")).join(
            knn_proba(near, place, get("weights")), "query_id"
        ).select(
            F.col("query_id").alias(key),
            F.col("prediction").cast("double"),
            array_to_vector("probability").alias("probability"),
        )
        return dataset.join(result, key, "left")


# Trainers by name: functions of the number of classes, the weight column, the row id and parameters.
MODELS: dict[str, Callable[..., Estimator]] = {}

# How a kind's prediction becomes a class code, if it is not one.
DECISIONS: dict[str, str] = {}


def register_model(kind: str, make: Callable[..., Estimator], decision: str = "label") -> None:
    """Make a trainer known to runs, suites and searches under this name.

    ``make(classes, weight, identifier, **params)`` returns an estimator that reads ``features``,
    ``label`` and, if ``weight`` is not empty, that column, and whose model adds ``prediction`` and,
    if it has any, ``probability``. ``decision`` says how a prediction becomes a class code.
    """
    MODELS[kind] = make
    DECISIONS[kind] = decision


def make_model(
    kind: str, classes: int = 2, weight: str = "", identifier: str = "doc_id", **params
) -> Estimator:
    """A trainer by name, with the parameters of its kind."""
    if kind not in MODELS:
        raise ValueError(f"unknown model {kind!r}, expected one of {sorted(MODELS)}")
    return MODELS[kind](classes, weight, identifier, **params)


def _logistic(classes, weight, identifier, max_iter=1000, random_state=None, **params):
    return LogisticTrainer(weightCol=weight, maxIter=max_iter, **params)


def _network(simple: bool):
    def make(classes, weight, identifier, hidden_size=128, **params):
        params.setdefault("patience", 0 if simple else 10)
        hidden = [hidden_size] * (1 if simple else 2) + [hidden_size // 2]
        return NetworkTrainer(
            hidden=hidden, classes=classes, identifier=identifier, weightCol=weight, **params
        )

    return make


def _neighbours(classes, weight, identifier, **params):
    return NeighbourTrainer(identifier=identifier, weightCol=weight, **params)


def _boosted(number: bool):
    def make(classes, weight, identifier, **params):
        own = ("n_estimators", "max_depth", "learning_rate", "seed")
        extra = {k: v for k, v in params.items() if k not in own}
        return BoostedTreesTrainer(
            classes=0 if number else classes, weightCol=weight, extra=json.dumps(extra),
            **{k: params[k] for k in own if k in params},
        )

    return make


register_model("logistic_regression", _logistic)
register_model("neural_network", _network(simple=False))
register_model("neural_network_simple", _network(simple=True))
register_model("knn_classifier", _neighbours)
register_model("gbt_classifier", _boosted(number=False))
register_model("gbt_regressor", _boosted(number=True), decision="threshold")


def model_info(kind: str, model, classes: list) -> dict:
    """Kind, sizes and classes of a fitted model; ``model_size`` counts its numbers."""
    core = model
    if isinstance(model, PipelineModel):
        known = ("weights", "numFeatures")
        core = next((s for s in model.stages if any(hasattr(s, k) for k in known)), model)
    size, width = None, getattr(core, "numFeatures", None)
    if isinstance(core, NeighbourModel):
        size = core.table.count()
    elif isinstance(core, BoostedModel):
        size, width = core.fitted.n_nodes, core.fitted.width
    elif hasattr(core, "coefficientMatrix"):
        matrix = core.coefficientMatrix
        size = matrix.numRows * (matrix.numCols + 1)
    elif hasattr(core, "weights"):
        size = len(core.weights)
    return {
        "model_type": kind,
        "n_features": width,
        "n_classes": len(classes),
        "classes": classes,
        "model_size": size if size is None else int(size),
    }
