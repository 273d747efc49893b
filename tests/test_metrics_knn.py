import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiform.operators import knn, metrics, ranks
from lexiform.operators.profile import label_predictions


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(
        list(zip([0, 0, 1, 1, 2], [0, 1, 1, 1, 0])), "target int, prediction int"
    )


def test_scores(pairs):
    scores = metrics.f1_scores(pairs).first()
    assert scores["accuracy"] == pytest.approx(0.6)
    assert scores["f1_macro"] == pytest.approx((0.5 + 0.8 + 0) / 3)
    assert scores["f1_weighted"] == pytest.approx(0.4 * 0.5 + 0.4 * 0.8)
    assert metrics.accuracy(pairs).first()["accuracy"] == pytest.approx(0.6)


def test_report_and_matrix(pairs):
    report = {r["label"]: r for r in metrics.classification_report(pairs).collect()}
    assert report["2"]["recall"] == report["2"]["precision"] == 0
    assert report["macro avg"]["support"] == 5 and len(report) == 6
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in metrics.confusion_matrix(pairs).collect()}
    assert len(cells) == 9 and cells[(1, 1)] == 2 and cells[(2, 2)] == 0 and cells[(2, 0)] == 1


def test_names(spark, pairs):
    names = spark.createDataFrame([(0, "no"), (1, "yes")], "target int, target_name string")
    made = label_predictions(pairs, names)
    assert {(r["prediction"], r["prediction_name"]) for r in made.collect()} == {(0, "no"), (1, "yes")}


def frames(spark, queries, train):
    return (
        spark.createDataFrame(queries, "doc_id bigint, features array<double>"),
        spark.createDataFrame(train, "doc_id bigint, features array<double>, target int"),
    )


def test_votes(spark):
    asked, known = frames(
        spark,
        [(1, [0.0])],
        [(10, [0.0], 1), (11, [1.0], 0), (12, [1.0], 0), (13, [-1.0], 1), (14, [9.0], 0)],
    )
    near = knn.k_nearest(asked, known, 4)
    assert [r["neighbour_id"] for r in near.orderBy("rank").collect()] == [10, 11, 12, 13]
    assert knn.knn_predict(near).first()["prediction"] == 0
    assert knn.knn_predict(near, "distance").first()["prediction"] == 1
    assert knn.knn_proba(near, [0, 1], "distance").first()["probability"] == [0.0, 1.0]
    assert knn.knn_proba(near, [0, 1]).first()["probability"] == [0.5, 0.5]
    with pytest.raises(ValueError):
        knn.votes(near, "rank")
    with pytest.raises(ValueError):
        knn.k_nearest(asked, known, metric="cosine")


@pytest.mark.parametrize("p", [1, 2, 3])
@pytest.mark.parametrize("small", [True, False])
def test_against_brute_force(spark, monkeypatch, p, small):
    if not small:
        monkeypatch.setattr(knn, "BROADCAST_NUMBERS", 10)
        monkeypatch.setattr(knn, "BLOCK_ROWS", 17)
    random = np.random.default_rng(p)
    q, t = random.normal(size=(40, 5)).round(1), random.normal(size=(90, 5)).round(1)
    t[:30] = t[0]
    asked, known = frames(
        spark,
        [(i, v.tolist()) for i, v in enumerate(q)],
        [(i, v.tolist(), i % 3) for i, v in enumerate(t)],
    )
    found = {}
    for row in knn.k_nearest(asked, known.repartition(3), 7, p).collect():
        found.setdefault(row["query_id"], {})[row["rank"]] = row["neighbour_id"]
    for i, point in enumerate(q):
        gap = ((np.abs(point - t) ** p).sum(axis=1) ** (1 / p)).round(9)
        order = sorted(range(len(t)), key=lambda j: (gap[j], j))[:7]
        assert [found[i][r] for r in range(1, 8)] == order


def brute(q, t, k, p):
    found = {}
    for i, point in enumerate(q):
        gap = ((np.abs(point - t) ** p).sum(axis=1) ** (1 / p)).round(9)
        order = sorted(range(len(t)), key=lambda j: (gap[j], j))[:k]
        found.update({(i, r): (j, gap[j]) for r, j in enumerate(order, 1)})
    return found


@pytest.mark.parametrize("p", [0.5, 1, 2, 3])
def test_pivots_against_brute_force(spark, monkeypatch, p):
    monkeypatch.setattr(knn, "CELL_ROWS", 20)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 30)
    random = np.random.default_rng(11)
    centres = random.normal(size=(25, 4)) * 20
    t = (centres[random.integers(0, 25, 900)] + random.normal(size=(900, 4))).round(1)
    q = (centres[random.integers(0, 25, 300)] + random.normal(size=(300, 4))).round(1)
    t[:300] = t[0]  # a third of the rows are equal
    q[:50] = t[0]
    asked, known = frames(
        spark,
        [(i, v.tolist()) for i, v in enumerate(q)],
        [(i, v.tolist(), i % 3) for i, v in enumerate(t)],
    )
    schema = "query_id bigint, neighbour_id bigint, label int, distance double"
    asked = asked.withColumnsRenamed({"doc_id": "id", "features": "v"})
    known = known.withColumnsRenamed({"doc_id": "id", "features": "v", "target": "label"})
    candidates = knn.by_pivots(asked, known, 7, p, schema, 4)
    wanted = brute(q, t, 7, p)
    best = {}
    for row in candidates.collect():
        best.setdefault(row["query_id"], set()).add((round(row["distance"], 9), row["neighbour_id"]))
    for i in range(300):
        ranked = sorted(best[i])[:7]
        assert [j for _, j in ranked] == [wanted[i, r][0] for r in range(1, 8)]


def test_pivots_leave_most_cells_alone(spark, monkeypatch):
    monkeypatch.setattr(knn, "CELL_ROWS", 25)
    random = np.random.default_rng(12)
    centres = random.normal(size=(20, 4)) * 30
    t = centres[random.integers(0, 20, 1500)] + random.normal(size=(1500, 4))
    q = centres[random.integers(0, 20, 200)] + random.normal(size=(200, 4))
    known = spark.createDataFrame(
        [(i, v.tolist(), 0) for i, v in enumerate(t)], "id bigint, v array<double>, label int"
    )
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id bigint, v array<double>")
    pivots = knn.chosen_pivots(known, 4, 2)
    rows = knn.celled(known, pivots)
    assert len(pivots.points) == 38 and rows.count() == pivots.counts.sum() == 1500
    wanted = brute(q, t, 5, 2)
    limits = spark.createDataFrame(
        [(i, float(wanted[i, 5][1])) for i in range(200)], "id bigint, limit double"
    )
    first, second = knn.visits(asked, pivots, 5), knn.visits(asked, pivots, 5, limits)
    assert first.join(second, ["id", "cell"]).isEmpty()
    assert first.count() + second.count() < 200 * 38 / 6


def test_pivots_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(knn, "BROADCAST_NUMBERS", 2)
    monkeypatch.setattr(knn, "CELL_ROWS", 1)
    asked, known = frames(
        spark, [(i, [float(i)]) for i in range(9)], [(1, [1.0], 0), (2, [5.0], 1), (3, [5.0], 1)]
    )
    found = knn.k_nearest(asked, known, 5)
    assert found.groupBy("query_id").count().filter("count = 3").count() == 9
    assert knn.k_nearest(asked, known.limit(0), 5).count() == 0


def test_text_ids_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "WORKING_NUMBERS", 50)
    asked = spark.createDataFrame([("q1", [0.0, 0.0]), ("q2", [5.0, 5.0])], "doc_id string, features array<double>")
    known = spark.createDataFrame(
        [(f"t{i:02d}", [float(i % 4), 0.0], i % 2) for i in range(60)],
        "doc_id string, features array<double>, target int",
    )
    for p in (1, 2):
        rows = knn.k_nearest(asked, known, 3, p).orderBy("query_id", "rank").collect()
        assert [r["neighbour_id"] for r in rows] == ["t00", "t04", "t08", "t03", "t07", "t11"]


def test_no_queries(spark):
    asked, known = frames(spark, [], [(1, [1.0], 0)])
    assert knn.k_nearest(asked, known).count() == 0
    assert asked.select(F.count("*")).first()[0] == 0


def test_ranking_with_ties(spark, monkeypatch):
    random = np.random.default_rng(13)
    scores = random.integers(0, 30, 400) / 10
    positive = random.random(400) < 0.3 + scores / 10
    rows = [(bool(p), float(s)) for p, s in zip(positive, scores)]
    odd = [(None, 1.0), (True, None), (False, float("nan"))]
    frame = spark.createDataFrame(rows + odd, "p boolean, s double")
    up, down = scores[positive], scores[~positive]
    won = (up[:, None] > down).sum() + (up[:, None] == down).sum() / 2
    levels = sorted(set(scores), reverse=True)
    recall = [(up >= t).mean() for t in levels]
    precision = [(up >= t).sum() / (scores >= t).sum() for t in levels]
    average = sum(p * (r - q) for p, r, q in zip(precision, recall, [0, *recall]))
    for size in (500_000, 4):
        monkeypatch.setattr(ranks, "RANGE_SCORES", size)
        made = ranks.ranking_scores(frame, F.col("p"), F.col("s")).first()
        assert made["roc_auc"] == pytest.approx(won / len(up) / len(down))
        assert made["average_precision"] == pytest.approx(average)
        assert (made["n_positive"], made["n_negative"]) == (len(up), len(down))
    one_side = ranks.ranking_scores(frame.filter("p"), F.col("p"), F.col("s")).first()
    assert one_side["roc_auc"] is None and one_side["average_precision"] == 1.0
    nothing = ranks.ranking_scores(frame.limit(0), F.col("p"), F.col("s")).first()
    assert nothing["roc_auc"] is None and nothing["n_positive"] == 0


def test_metrics_by_name(spark, monkeypatch):
    monkeypatch.setattr(metrics, "METRICS", dict(metrics.METRICS))
    metrics.register_metric("hits", lambda rows: F.count_if(F.col("target") == F.col("prediction")))
    metrics.register_metric("one", lambda rows: 1.0)
    metrics.register_metric("none", lambda rows: None)
    rows = spark.createDataFrame(
        [(5, 5, 0, [0.75, 0.25]), (7, 5, 1, [0.5, 0.5]), (7, 7, 1, [0.25, 0.75])],
        "target int, prediction int, label int, chances array<double>",
    )
    made = metrics.metric_values(rows, ["hits", "one", "none", "log_loss", "brier_score", "roc_auc", "accuracy"])
    assert made == {
        "hits": 2.0, "one": 1.0, "roc_auc": 1.0, "accuracy": pytest.approx(2 / 3),
        "log_loss": pytest.approx(-(2 * np.log(0.75) + np.log(0.5)) / 3),
        "brier_score": pytest.approx((0.125 + 0.5 + 0.125) / 3),
    }
    three = rows.withColumn("chances", F.array(F.lit(0.2), F.lit(0.3), F.col("chances")[1]))
    assert metrics.metric_values(three, ["roc_auc"])["roc_auc"] == pytest.approx(0.5)
    with pytest.raises(ValueError, match="unknown metrics"):
        metrics.metric_values(rows, ["no such"])


def test_distances_are_held_in_bounded_steps():
    """Twenty thousand rows met by many queries stay within a few tens of megabytes."""
    draw = np.random.default_rng(1)
    rows, queries = draw.normal(size=(20_000, 4)), draw.normal(size=(400, 4))
    tracemalloc.start()
    found = knn.nearest(
        np.arange(400), queries, np.arange(20_000), np.zeros(20_000, int), rows, 3, 2
    )
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 1200 and most < 50e6
