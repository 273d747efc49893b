import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiform.operators import skyline, trials
from lexiform.sources import trials_store

OBJECTIVES = [("accuracy", False), ("training_time", True)]


def history(spark, values, status=None):
    rows = []
    for i, value in enumerate(values):
        metrics = {k: float(v) for k, v in value.items() if v is not None}
        rows.append((i, (status or {}).get(i, "completed"), {"model_C": str(i)}, metrics))
    return spark.createDataFrame(
        rows, "trial_index bigint, status string, params map<string,string>, metrics map<string,double>"
    )


def pairs(spark, values):
    return history(spark, [{"accuracy": a, "training_time": t} for a, t in values])


def indexes(df):
    return {r["trial_index"] for r in df.collect()}


def test_ties_on_the_frontier(spark):
    table = pairs(spark, [(0.9, 5), (0.9, 5), (0.8, 5), (0.8, 6)])
    assert indexes(trials.pareto_frontier(table, OBJECTIVES)) == {0, 1, 2}
    assert indexes(trials.pareto_frontier(table, OBJECTIVES, "weak")) == {0, 1}
    with pytest.raises(ValueError):
        trials.pareto_frontier(table, OBJECTIVES, "odd")


def dominates(a, b, weak):
    shared = [(x, y) for x, y in zip(a, b) if x is not None and y is not None]
    if not shared:
        return False
    if weak:
        return all(x >= y for x, y in shared) and any(x > y for x, y in shared)
    return all(x > y for x, y in shared)


@pytest.mark.parametrize("mode", ["strict", "weak"])
@pytest.mark.parametrize("names", [["m0"], ["m0", "m1"], ["m0", "m1", "m2"]])
@pytest.mark.parametrize("small", [False, True])
def test_frontier_against_brute_force(spark, monkeypatch, mode, names, small):
    if small:
        monkeypatch.setattr(skyline, "BLOCK_ROWS", 5)
        monkeypatch.setattr(skyline, "BUCKET_VALUES", 3)
        monkeypatch.setattr(skyline, "CELLS", 30)
    random = np.random.default_rng(3)
    objectives = [(n, n == "m1") for n in names]
    for missing in (0.0, 0.15):
        values = [
            [None if random.random() < missing else float(random.integers(0, 12)) for _ in names]
            for _ in range(150)
        ]
        table = history(spark, [dict(zip(names, v)) for v in values]).repartition(4)
        found = indexes(trials.pareto_frontier(table, objectives, mode))
        turned = [
            [-x if minimize and x is not None else x for x, (_, minimize) in zip(v, objectives)]
            for v in values
        ]
        expected = {
            i for i, v in enumerate(turned)
            if any(x is not None for x in v)
            and not any(dominates(o, v, mode == "weak") for j, o in enumerate(turned) if j != i)
        }
        assert found == expected


def test_all_on_the_frontier(spark, monkeypatch):
    monkeypatch.setattr(skyline, "BUCKET_VALUES", 5_000)
    ids = spark.range(100_000).select(
        F.col("id"), F.col("id").cast("double").alias("x"), (-F.col("id")).cast("double").alias("y")
    )
    two = [F.col("x"), F.col("y")]
    assert skyline.skyline(ids, two).count() == skyline.skyline(ids, two, True).count() == 100_000
    # Three columns on a plane: no point beats another.
    plane = spark.range(4_000).select(
        F.col("id"), (F.col("id") % 61).cast("double").alias("x"), (F.col("id") % 53).cast("double").alias("y")
    ).withColumn("z", -F.col("x") - F.col("y"))
    monkeypatch.setattr(skyline, "BLOCK_ROWS", 64)
    three = [F.col("x"), F.col("y"), F.col("z")]
    assert skyline.skyline(plane, three, True).count() == 4_000
    below = plane.select(F.col("id") + 4_000, F.col("x"), F.col("y"), F.col("z") - 0.5)
    assert skyline.skyline(plane.union(below), three, True).agg(F.max("id")).first()[0] < 4_000


def test_many_copies_of_the_best(spark):
    rows = spark.range(60_000).select(
        F.col("id").alias("trial_index"), F.lit("completed").alias("status"),
        F.create_map().cast("map<string,string>").alias("params"),
        F.create_map(
            F.lit("accuracy"), F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") / 1e6),
            F.lit("training_time"), F.when(F.col("id") % 3 == 0, 1.0).otherwise(2.0 + F.col("id")),
        ).alias("metrics"),
    )
    found = trials.pareto_frontier(rows, OBJECTIVES)
    assert found.count() == 20_000 and found.filter("trial_index % 3 != 0").isEmpty()


def test_convergence_carries_over_gaps(spark, monkeypatch):
    table = history(spark, [{"accuracy": 0.5}, {}, {"val_accuracy": 0.7}, {"accuracy": 0.6}])
    for bucket in (65_536, 2):
        monkeypatch.setattr(trials, "BUCKET_TRIALS", bucket)
        rows = trials.convergence(table, [("accuracy", False)]).orderBy("trial_index").collect()
        assert [r["best"] for r in rows] == [0.5, 0.5, 0.7, 0.7]


def test_best_trial_and_thresholds(spark):
    table = pairs(spark, [(0.7, 4), (0.9, 6), (0.9, 3), (0.8, 3)])
    best = {r["objective"]: r["trial_index"] for r in trials.best_trial(table, OBJECTIVES).collect()}
    assert best == {"accuracy": 1, "training_time": 2}
    kept = trials.threshold_filter(table, OBJECTIVES, {"accuracy": 0.8, "training_time": 4, "x": 1})
    assert indexes(kept) == {2, 3}
    single = trials.best_trial(table, [("training_time", True)]).collect()
    assert [r["trial_index"] for r in single] == [2]


def test_preferences(spark):
    table = pairs(spark, [(0.9, 4)])
    scored = trials.recommend_configs(table, OBJECTIVES, {"accuracy": 0.7, "training_time": 0.3})
    assert scored.first()["score"] == pytest.approx(0.69)
    assert trials.recommend_configs(table, OBJECTIVES).count() == 1
    assert trials.recommend_configs(table, OBJECTIVES, {"unknown": 1.0}).count() == 0
    nothing = history(spark, [{}])
    assert trials.recommend_configs(nothing, OBJECTIVES).count() == 0


def test_status(spark):
    planned = spark.range(3).withColumnRenamed("id", "trial_index")
    recorded = spark.createDataFrame([(0, "completed"), (1, "failed")], "trial_index bigint, status string")
    made = {r["trial_index"]: r["status"] for r in trials.trial_status(planned, recorded).collect()}
    assert made == {0: "completed", 1: "failed", 2: "running"}


def test_store_and_export(spark, tmp_path):
    path = f"{tmp_path}/trials"
    records = spark.createDataFrame(
        [
            (0, "a", {"model_C": "1.0"}, {"accuracy": "0.9", "target_names": '["x"]', "n": "3"}, 1.5, None, "completed"),
            (1, "b", {"model_C": "2.0"}, None, 0.5, "boom", "failed"),
        ],
        f"{trials_store.TRIAL_SCHEMA}, status string",
    )
    trials_store.save_trials(records.filter("trial_index = 0"), path)
    trials_store.save_trials(records.filter("trial_index = 1"), path)
    rows = {r["trial_index"]: r for r in trials_store.read_trials(spark, path).collect()}
    assert rows[0]["metrics"] == {"accuracy": 0.9, "n": 3.0} and rows[0]["status"] == "completed"
    assert rows[1]["error"] == "boom" and rows[1]["status"] == "failed"
    assert trials_store.trial_record(spark, path, 1)["error"] == "boom"
    assert trials_store.trial_record(spark, path, 7) == {"status": "running"}
    table = pairs(spark, [(0.9, 5), (0.8, 6)])
    wide = trials.trial_wide(table, OBJECTIVES, ["model_C"], ["accuracy"]).orderBy("trial_index").collect()
    assert [tuple(r) for r in wide] == [(0, "COMPLETED", True, "0", 0.9), (1, "COMPLETED", False, "1", 0.8)]
    trials_store.export_search(table, OBJECTIVES, f"{tmp_path}/export", "demo")
    summary = json.loads(spark.read.text(f"{tmp_path}/export/summary").first()[0])
    assert summary == {"experiment_name": "demo", "total_trials": 2, "pareto_frontier_size": 1}
    assert spark.read.json(f"{tmp_path}/export/trials").filter("is_pareto_optimal").count() == 1
    items = {r["item"] for r in trials.search_summary(table, OBJECTIVES).collect()}
    assert items == {"total_trials", "best_accuracy", "best_training_time", "frontier"}


def test_failed_trials_stay_out(spark):
    table = history(spark, [{"accuracy": 0.9}, {"accuracy": 0.8}], {0: "failed"})
    assert trials.best_trial(table, [("accuracy", False)]).first()["trial_index"] == 1
    assert table.select(F.count("*")).first()[0] == 2
