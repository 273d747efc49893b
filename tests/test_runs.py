import json

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiform.functions.text import tokenize_whitespace
from lexiform.operators.pooling import mean_pool
from lexiform.plans import models, runs, search
from lexiform.plans.models import LogisticTrainer, NetworkTrainer, make_model
from lexiform.sources.trials_store import save_experiments
from lexiform.streaming.score import pool_stream, read_batches, score_stream

EMBEDDED = {"extractor": "sentence_embeddings", "extractor_params": {"size": 16}}


def newton(x, y, w, c):
    """L2 logistic regression with a free intercept, by Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = c * design.T @ (w * (p - y)) + penalty @ beta
        hessian = c * (design.T * (w * p * (1 - p))) @ design + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta


@pytest.mark.parametrize("weight", ["", "weight"])
def test_logistic_regression_solves_its_objective(spark, weight):
    random = np.random.default_rng(0)
    x = random.normal(size=(60, 3))
    y = (x @ [1.0, -2.0, 0.5] + random.normal(size=60) > 0.4).astype(float)
    w = np.where(y == 1, 3.0, 1.0)
    rows = [(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, y, w)]
    df = spark.createDataFrame(rows, ["features", "label", "weight"])
    model = LogisticTrainer(C=0.5, tol=1e-10, weightCol=weight).fit(df)
    expected = newton(x, y, w if weight else np.ones(60), 0.5)
    assert np.allclose([*model.coefficients, model.intercept], expected, atol=1e-4)


@pytest.mark.parametrize(
    "model, params, weighted",
    [
        ("logistic_regression", {"C": 10.0}, True),
        ("neural_network", {"hidden_size": 8, "epochs": 40}, True),
        ("neural_network_simple", {"hidden_size": 8, "epochs": 40}, False),
        ("knn_classifier", {"n_neighbors": 3}, True),
        ("gbt_classifier", {"n_estimators": 3, "max_depth": 3}, True),
        ("gbt_regressor", {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.9}, True),
    ],
)
def test_models(spark, reviews, tmp_path, model, params, weighted):
    result = runs.classification_run(
        reviews, model=model, model_params=params, use_class_weights=weighted,
        save_path=f"{tmp_path}/run", **EMBEDDED,
    )
    rows = result.predictions.collect()
    assert len(rows) == 8 == result.scores["n_test"]
    assert {r["prediction"] for r in rows} <= {0, 1}
    assert {r["prediction_name"] for r in rows} <= {"class_0", "class_1"}
    assert result.scores["accuracy"] == 1.0 and result.scores["model_size"] > 0
    if "probability" in result.predictions.columns:
        total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x)
        assert all(abs(r[0] - 1) < 1e-9 for r in result.predictions.select(total).collect())
    loaded = runs.load_run(spark, f"{tmp_path}/run")
    again = {r["doc_id"]: r["prediction"] for r in loaded.predict(reviews).collect()}
    assert all(again[r["doc_id"]] == r["prediction"] for r in rows)


def test_any_class_codes_and_several_classes(spark, reviews):
    third = F.when(F.col("doc_id") % 3 == 0, 7).when(F.col("doc_id") % 3 == 1, -2).otherwise(30)
    rows = reviews.withColumn("target", third.cast("int"))
    rows = rows.withColumn("text", F.concat("text", F.lit(" word"), F.abs("target")))
    for model, params in (
        ("logistic_regression", {"C": 100.0}),
        ("gbt_classifier", {"n_estimators": 2, "max_depth": 2}),
        ("knn_classifier", {"n_neighbors": 3}),
    ):
        result = runs.classification_run(rows, "tfidf_vectorizer", model, model_params=params)
        assert {r["prediction"] for r in result.predictions.collect()} <= {7, -2, 30}
        assert result.fitted.settings["model_info"]["classes"] == [-2, 7, 30]


def test_class_weights_help_the_smaller_class(spark):
    rows = [(i, ("rare" if i % 10 == 0 else "usual") + f" text{i % 3}", int(i % 10 == 0)) for i in range(100)]
    rows += [(200 + i, f"rare text{i % 3}", 0) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, target int")

    def recall(weighted):
        found = runs.classification_run(df, use_class_weights=weighted).predictions
        minor = found.filter("target = 1")
        return minor.filter("prediction = 1").count() / minor.count()

    assert recall(True) >= recall(False) and recall(True) == 1.0


def test_seeded_runs_agree(spark, reviews):
    def once():
        result = runs.classification_run(
            reviews, model="neural_network", model_params={"hidden_size": 4, "epochs": 10}, **EMBEDDED
        )
        return sorted((r["doc_id"], r["prediction"]) for r in result.predictions.collect())

    assert once() == once()


def test_early_stopping_ends_before_the_last_epoch(spark):
    rows = [(i, Vectors.dense([float(i % 2), float(i % 5)]), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, ["doc_id", "features", "label"])
    fitted = NetworkTrainer(hidden=[4], epochs=400, block=5, patience=5).fit(df)
    assert fitted.transform(df).filter("prediction != label").count() == 0


def test_numeric_columns(spark, tmp_path):
    rows = [(i, float(i % 2), float(i % 5), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, m_a double, m_b double, target int")
    result = runs.classification_run(
        df, "columns", extractor_params={"include": ["m_*"]}, save_path=f"{tmp_path}/run"
    )
    assert result.scores["accuracy"] == 1.0 and result.scores["n_train"] == 32
    assert runs.load_run(spark, f"{tmp_path}/run").predict(df).filter("prediction != target").isEmpty()


def test_unknown_names(spark, reviews):
    with pytest.raises(ValueError, match="unknown model"):
        make_model("oracle")
    with pytest.raises(ValueError, match="unknown extractor"):
        runs.make_extractor("oracle")


def test_batch_and_stream_agree(spark, reviews, tmp_path):
    fitted = runs.classification_run(reviews, "tfidf_vectorizer", use_class_weights=True).fitted
    texts = reviews.select("doc_id", "text")
    texts.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(texts.schema).parquet(f"{tmp_path}/in")
    score_stream(fitted, stream, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()

    def pairs(df):
        return sorted((r["doc_id"], r["prediction"], r["prediction_name"]) for r in df.collect())

    assert pairs(spark.read.parquet(f"{tmp_path}/out")) == pairs(runs.score_text(fitted, texts))


@pytest.mark.parametrize("extractor", [EMBEDDED, {"extractor_params": {"max_features": None}}])
def test_streams_meet_tables_across_restarts(spark, reviews, tmp_path, extractor):
    """Batches join the training rows or terms; a second start takes up where the first ended."""
    fitted = runs.classification_run(reviews, model="knn_classifier", **extractor).fitted
    texts = reviews.select("doc_id", "text")
    for part in range(2):
        texts.filter(F.col("doc_id") % 2 == part).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        score_stream(fitted, stream, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
    made = read_batches(spark, f"{tmp_path}/out")
    wanted = runs.score_text(fitted, texts)
    names = ["doc_id", "prediction", "prediction_name"]
    assert sorted(made.select(names).collect()) == sorted(wanted.select(names).collect())


def test_pooled_stream_equals_batch(spark, reviews, tmp_path):
    vectors = spark.createDataFrame([("good", [1.0, 0.0]), ("food", [0.0, 2.0])], "word string, vector array<double>")
    texts = reviews.select("doc_id", "text")
    texts.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    pool_stream(stream, vectors, 2, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
    bags = texts.select("doc_id", tokenize_whitespace("text").alias("tokens"))
    wanted = mean_pool(bags, vectors, 2)
    made = read_batches(spark, f"{tmp_path}/out").select(wanted.columns)
    assert sorted(map(str, made.collect())) == sorted(map(str, wanted.collect()))


def test_run_name():
    from datetime import datetime

    name = runs.run_name("count_vectorizer", "logistic_regression", datetime(2024, 5, 6, 7, 8, 9))
    assert name == "pipeline_count_vectorizer_logistic_regression_20240506_070809"


def test_suite_records_successes_and_failures(spark, reviews, tmp_path):
    reviews.write.parquet(f"{tmp_path}/reviews")
    configs = [
        {"description": "counts", "extractor": "count_vectorizer"},
        {"description": "own source", "source": "table", "loader_params": {"path": f"{tmp_path}/reviews"}},
        {"description": "broken", "extractor_params": {"min_df": 99}},
    ]
    records = runs.experiment_suite(spark, configs, reviews, parallel=2)
    rows = {r["description"]: r for r in records.collect()}
    assert rows["counts"]["status"] == rows["own source"]["status"] == "success"
    assert rows["broken"]["status"] == "failed" and rows["broken"]["error"]
    performance = rows["counts"]["performance"]
    assert performance["confusion_matrix"] == [[6, 0], [0, 2]]
    assert performance["classification_report"]["accuracy"]["precision"] == 1.0
    assert json.loads(rows["counts"]["feature_info"])["vocab_size"] > 5
    save_experiments(records, f"{tmp_path}/records")
    assert spark.read.json(f"{tmp_path}/records").count() == 3
    summary = {r["status"]: r["n"] for r in runs.experiment_summary(runs.experiment_outcomes(records)).collect()}
    assert summary == {"success": 2, "failed": 1}


def test_parameters():
    for bad in (
        search.Parameter("range", lower=1.0), search.Parameter("choice"), search.Parameter("fixed"),
        search.Parameter("guess"), search.Parameter("range", lower=0.0, upper=1.0, log=True),
    ):
        with pytest.raises(ValueError):
            bad.check("x")


def test_grid_and_samples(spark):
    space = search.SearchSpace(
        {"max_features": search.Parameter("choice", "int", values=[10, 20])},
        {"C": search.Parameter("range", "float", 0.01, 100.0, log=True)},
        {"mode": search.Parameter("fixed", "string", value="x")},
    )
    grid = search.grid_trials(spark, space, points=3)
    assert grid.columns == ["trial_index", "extractor_max_features", "model_C", "training_mode"]
    rows = {(r[1], round(r[2], 6), r[3]) for r in grid.collect()}
    assert rows == {(m, c, "x") for m in (10, 20) for c in (0.01, 1.0, 100.0)}
    drawn = search.sample_trials(spark.range(500).withColumnRenamed("id", "trial_index"), space)
    values = drawn.collect()
    assert {r["extractor_max_features"] for r in values} == {10, 20}
    assert all(0.01 <= r["model_C"] < 100.0 for r in values)
    assert 150 < sum(r["model_C"] < 1.0 for r in values) < 350
    assert search.default_space("tfidf_vectorizer", "knn_classifier").parameters().keys() == {
        "extractor_max_features", "extractor_min_df", "extractor_max_df",
        "model_n_neighbors", "model_weights",
    }


def test_search(spark, reviews, tmp_path):
    space = search.SearchSpace(
        {"max_features": search.Parameter("choice", "int", values=[3, 50])},
        {"C": search.Parameter("fixed", "float", value=5.0)},
    )
    table = search.hyperparameter_search(
        reviews, f"{tmp_path}/search", space=space, total_trials=3, parallel=2
    )
    rows = {r["trial_index"]: r for r in table.collect()}
    assert set(rows) == {0, 1, 2} and all(r["status"] == "completed" for r in rows.values())
    assert rows[0]["params"]["model_C"] == "5.0" and rows[0]["metrics"]["accuracy"] > 0.5
    assert {"prediction_time", "model_size", "precision_macro"} <= rows[0]["metrics"].keys()
    assert search.acceptable_trials(table).count() <= 3
    broken = search.SearchSpace({"min_df": search.Parameter("fixed", "int", value=1000)})
    failed = search.hyperparameter_search(reviews, f"{tmp_path}/broken", space=broken, total_trials=2)
    assert {r["status"] for r in failed.collect()} == {"failed"}
    assert all(r["error"] for r in failed.collect())


def test_networks_get_tasks_of_bounded_dense_rows(spark, monkeypatch):
    """The trainer makes rows dense, so sparse bytes do not bound what a task holds."""
    seen = []
    fit = models.MultilayerPerceptronClassifier.fit

    def recorded(self, frame):
        seen.append(frame.rdd.glom().map(len).collect())
        return fit(self, frame)

    monkeypatch.setattr(models.MultilayerPerceptronClassifier, "fit", recorded)
    monkeypatch.setattr(models, "DENSE_BYTES", 20 * 50 * 8)
    rows = [(i, Vectors.sparse(50, {i % 50: 1.0}), float(i % 2)) for i in range(200)]
    data = spark.createDataFrame(rows, ["doc_id", "features", "label"]).coalesce(1)
    models.make_model("neural_network_simple", hidden_size=2, epochs=1).fit(data)
    assert sum(seen[0]) == 200 and max(seen[0]) <= 40
