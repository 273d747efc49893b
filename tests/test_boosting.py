import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiform.operators import boosting, metrics
from lexiform.plans import models, runs, search
from lexiform.plans.models import make_model
from lexiform.plans.stages import Projection


def slopes(margins, y, w, objective):
    if objective == "squared":
        return w * (margins[:, 0] - y), w
    if objective == "logistic":
        p = 1 / (1 + np.exp(-margins[:, 0]))
        return w * (p - y), w * p * (1 - p)
    return None


def grow(x, g, h, depth, lam=1.0):
    """The predictions of a tree over all split points between bins of equal width."""
    out = np.zeros(len(x))

    def split(at, level):
        best = (0.0, None)
        for f in range(x.shape[1]):
            for b in np.unique(x[at, f])[:-1]:
                left = at[x[at, f] <= b]
                right = at[x[at, f] > b]
                if h[left].sum() < 1 or h[right].sum() < 1:
                    continue
                score = lambda i: g[i].sum() ** 2 / (h[i].sum() + lam)
                gain = round(0.5 * (score(left) + score(right) - score(at)), 9)
                if gain > best[0]:
                    best = (gain, (left, right))
        if level and best[1]:
            for side in best[1]:
                split(side, level - 1)
        elif level < depth:
            out[at] = -0.1 * g[at].sum() / (h[at].sum() + lam)

    split(np.arange(len(x)), depth)
    return out


def brute(x, y, w, objective, outputs, rounds, depth):
    low, high = x.min(axis=0), x.max(axis=0)
    edges = [np.unique(a + (b - a) * np.arange(1, 8) / 8) for a, b in zip(low, high)]
    bins = np.column_stack([np.searchsorted(e, x[:, i], "right") for i, e in enumerate(edges)])
    base = np.average(y, weights=w) if objective == "squared" else 0.0
    margins = np.full((len(x), outputs), base)
    for _ in range(rounds):
        if objective == "softmax":
            p = np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
            steps = [grow(bins, w * (p[:, c] - (y == c)), w * 2 * p[:, c] * (1 - p[:, c]), depth)
                     for c in range(outputs)]
        else:
            steps = [grow(bins, *slopes(margins, y, w, objective), depth)]
        margins = margins + np.column_stack(steps)
    return margins


def data(objective, n=300):
    random = np.random.default_rng(21)
    x = random.normal(size=(n, 4)).round(2)
    z = x[:, 0] * 2 - x[:, 1] + random.normal(size=n)
    y = {"squared": z, "logistic": (z > 0).astype(float), "softmax": np.digitize(z, [-1, 1]).astype(float)}
    return x, y[objective], random.choice([0.5, 1.0, 2.0], n)


@pytest.mark.parametrize("objective", boosting.OBJECTIVES)
@pytest.mark.parametrize("small", [False, True])
def test_boosting_equals_brute_force(spark, monkeypatch, objective, small):
    if small:
        monkeypatch.setattr(boosting, "REFRESH", 2)
        monkeypatch.setattr(boosting, "CELLS", 20)
    x, y, w = data(objective)
    rows = [(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, y, w)]
    df = spark.createDataFrame(rows, ["features", "label", "w"])
    outputs = 3 if objective == "softmax" else 1
    settings = boosting.Settings(n_estimators=3, max_depth=3, max_bins=8, binning="width")
    model = boosting.fit(df, outputs, objective, settings, weight="w")
    again = boosting.Boosted.from_json(model.to_json())
    assert np.allclose(again.margins(x, outputs), brute(x, y, w, objective, outputs, 3, 3))


def test_loss_falls_each_round(spark):
    x, y, w = data("softmax")
    df = spark.createDataFrame(
        [(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]
    )
    model = boosting.fit(df, 3, "softmax", boosting.Settings(n_estimators=6, max_depth=3))
    losses = []
    for rounds in range(7):
        part = boosting.Boosted(model.objective, model.base, model.rounds[:rounds], model.width)
        p = boosting.chances(part.margins(x, 3), "softmax")
        losses.append(-np.log(p[np.arange(len(y)), y.astype(int)]).mean())
    assert losses[0] == pytest.approx(np.log(3)) and all(a > b for a, b in zip(losses, losses[1:]))
    few = boosting.fit(df, 3, "softmax", boosting.Settings(n_estimators=2, subsample=0.5))
    assert 0 < few.n_nodes < boosting.fit(df, 3, "softmax", boosting.Settings(n_estimators=2)).n_nodes
    with pytest.raises(ValueError):
        boosting.fit(df, 1, "hinge", boosting.Settings())


@pytest.mark.parametrize(
    "kind, params",
    [
        ("logistic_regression", {}),
        ("neural_network_simple", {"hidden_size": 8, "epochs": 40}),
        ("neural_network", {"hidden_size": 8, "epochs": 40}),
        ("gbt_classifier", {"n_estimators": 8, "max_depth": 3, "reg_lambda": 0.5, "gamma": 0.01}),
    ],
)
def test_trained_models_beat_the_prior(spark, kind, params):
    """A model that has learnt nothing gives the prior's loss at best."""
    x, y, _ = data("logistic")
    df = spark.createDataFrame(
        [(i, Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x, y))],
        ["doc_id", "features", "label"],
    )

    def loss(model):
        rows = model.transform(df).select("label", vector_to_array("probability").alias("p")).collect()
        return -np.mean([np.log(max(r["p"][int(r["label"])], 1e-15)) for r in rows])

    prior = -np.mean(np.where(y == 1, np.log(y.mean()), np.log(1 - y.mean())))
    assert loss(make_model(kind, 2, **params).fit(df)) < 0.85 * prior
    untrained = {"logistic_regression": {"max_iter": 0}, "gbt_classifier": {"n_estimators": 0}}
    if kind in untrained:
        assert loss(make_model(kind, 2, **untrained[kind]).fit(df)) > 0.95 * prior


def test_models_extractors_and_metrics_of_the_user(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(models, "MODELS", dict(models.MODELS))
    monkeypatch.setattr(models, "DECISIONS", dict(models.DECISIONS))
    monkeypatch.setattr(runs, "EXTRACTORS", dict(runs.EXTRACTORS))
    monkeypatch.setattr(metrics, "METRICS", dict(metrics.METRICS))
    monkeypatch.setattr(runs, "DECISIONS", models.DECISIONS)
    models.register_model(
        "strong", lambda classes, weight, identifier, C=1.0: models.LogisticTrainer(weightCol=weight, C=10 * C)
    )
    runs.register_extractor("mine", lambda column="v": Projection(column=column, outputCol="features"))
    metrics.register_metric("wrong", lambda rows: F.count_if(F.col("target") != F.col("prediction")))
    x, y, _ = data("logistic", 120)
    rows = spark.createDataFrame(
        [(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))],
        "doc_id bigint, v array<double>, target int",
    )
    space = search.SearchSpace({}, {"C": search.Parameter("choice", "float", values=[0.5, 2.0])})
    found = search.hyperparameter_search(
        rows, f"{tmp_path}/search", "mine", "strong", space, total_trials=2, metrics=["wrong", "roc_auc"]
    )
    from lexiform.operators import trials

    kept = found.collect()
    assert all(r["status"] == "completed" for r in kept)
    for r in kept:
        assert r["metrics"]["wrong"] == round((1 - r["metrics"]["accuracy"]) * r["metrics"]["n_test"])
    best = trials.best_trial(found, [("wrong", True), ("roc_auc", False)]).collect()
    assert {r["objective"] for r in best} == {"wrong", "roc_auc"}


def test_assembled_columns_and_numbers(spark):
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(
        spark.range(100).selectExpr("double(id) AS a", "double(id * 3) AS label")
    )
    model = make_model("gbt_regressor", n_estimators=40, max_depth=4, learning_rate=0.3).fit(df)
    error = F.avg(F.abs(F.col("prediction") - F.col("label")))
    assert model.transform(df).agg(error).first()[0] < 8
