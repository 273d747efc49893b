"""Classification metrics over a table of true and predicted codes."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiform.cluster import settled
from lexiform.operators import ranks


def pair_counts(df: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """Rows per (true, predicted) pair. All metrics derive from this small table."""
    return df.groupBy(
        F.col(target).cast("int").alias("y_true"), F.col(prediction).cast("int").alias("y_pred")
    ).agg(F.count("*").alias("n"))


def confusion_matrix(
    df: DataFrame, target: str = "target", prediction: str = "prediction"
) -> DataFrame:
    """Every cell of the matrix over the labels seen on either side: y_true, y_pred, n."""
    counts, _ = settled(pair_counts(df, target, prediction))
    labels = sorted(
        row[0]
        for row in counts.select(F.explode(F.array("y_true", "y_pred"))).distinct().collect()
    )
    axis = F.array(*[F.lit(label) for label in labels]).cast("array<int>")
    seen = counts.groupBy("y_true").agg(
        F.map_from_entries(F.collect_list(F.struct("y_pred", "n"))).alias("_cells")
    )
    every = df.sparkSession.createDataFrame([(label,) for label in labels], "y_true int")
    return every.join(seen, "y_true", "left").select(
        "y_true", F.explode(axis).alias("y_pred"), "_cells"
    ).select(
        "y_true",
        "y_pred",
        F.coalesce(F.try_element_at("_cells", F.col("y_pred")), F.lit(0)).cast("bigint").alias("n"),
    )


def class_metrics(counts: DataFrame) -> DataFrame:
    """Per label: precision, recall, f1, support; 0 where undefined."""
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("y_true").alias("label"), hit.alias("tp"), F.col("n").alias("true"),
                         F.lit(0).cast("bigint").alias("pred")),
                F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("bigint").alias("tp"),
                         F.lit(0).cast("bigint").alias("true"), F.col("n").alias("pred")),
            )
        ).alias("_s")
    ).select("_s.*")
    totals = sides.groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("true").alias("support"), F.sum("pred").alias("pred")
    )

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    tp, support, pred = F.col("tp"), F.col("support"), F.col("pred")
    return totals.select(
        "label",
        "tp",
        ratio(tp, pred).alias("precision"),
        ratio(tp, support).alias("recall"),
        ratio(2 * tp, support + pred).alias("f1"),
        "support",
    )


def accuracy(df: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """Share of rows predicted right, in one row."""
    same = F.col(target).cast("double") == F.col(prediction).cast("double")
    return df.agg(F.avg(same.cast("double")).alias("accuracy"), F.count("*").alias("n"))


def summary_scores(counts: DataFrame) -> DataFrame:
    """Accuracy with macro and weighted averages, in one row."""

    def weighted(name: str):
        return F.sum(F.col(name) * F.col("support")) / F.sum("support")

    return class_metrics(counts).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
        F.sum("support").alias("support"),
    )


def f1_scores(df: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """All summary scores of a prediction table, in one row."""
    return summary_scores(pair_counts(df, target, prediction))


def classification_report(
    df: DataFrame, target: str = "target", prediction: str = "prediction"
) -> DataFrame:
    """One row per class, then accuracy, macro avg and weighted avg."""
    counts, _ = settled(pair_counts(df, target, prediction))
    classes = class_metrics(counts)
    scores = summary_scores(counts)
    columns = ["precision", "recall", "f1", "support"]
    rows = [classes.select(F.col("label").cast("string").alias("label"), *columns)]
    rows.append(
        scores.select(
            F.lit("accuracy").alias("label"),
            *[F.col("accuracy").alias(c) for c in columns[:3]],
            "support",
        )
    )
    for average in ("macro", "weighted"):
        rows.append(
            scores.select(
                F.lit(f"{average} avg").alias("label"),
                *[F.col(f"{c}_{average}").alias(c) for c in columns[:3]],
                "support",
            )
        )
    report = rows[0]
    for other in rows[1:]:
        report = report.unionByName(other)
    return report


# Metrics by name, over a table of target, prediction, label (the position of the target among the
# known classes, null if it is none of them) and chances (the probabilities of the classes, if the
# model has any). A metric gives an aggregate of that table, which is computed together with others
# in one pass, or a number.
Metric = Callable[[DataFrame], Column | float | None]
METRICS: dict[str, Metric] = {}


def register_metric(name: str, metric: Metric) -> None:
    """Make a metric known to runs, suites and searches under this name."""
    METRICS[name] = metric


def metric_values(rows: DataFrame, names: Iterable[str]) -> dict[str, float]:
    """The named metrics of a prediction table; those without a value are left out."""
    unknown = [n for n in names if n not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}, expected some of {sorted(METRICS)}")
    made = {name: METRICS[name](rows) for name in names}
    sums = {n: v for n, v in made.items() if isinstance(v, Column)}
    if sums:
        row = rows.agg(*[v.cast("double").alias(n) for n, v in sums.items()]).first()
        made.update(row.asDict())
    return {n: float(made[n]) for n in names if made[n] is not None}


def chance_of_target() -> Column:
    return F.get("chances", F.col("label"))


def log_loss(rows: DataFrame) -> Column:
    """Mean negative logarithm of the probability of the true class."""
    return F.avg(-F.log(F.greatest(chance_of_target(), F.lit(1e-15))))


def brier_score(rows: DataFrame) -> Column:
    """Mean squared distance of the probabilities from the true class."""
    off = F.aggregate(
        F.transform(
            "chances", lambda p, i: F.pow(p - (i == F.col("label")).cast("double"), F.lit(2.0))
        ),
        F.lit(0.0), lambda a, x: a + x,
    )
    return F.avg(off)


def over_classes(metric: Callable[[DataFrame, Column, Column], float | None]) -> Metric:
    """A metric of two classes as its mean over the classes, each against the rest; of two classes it
    is that of the second."""

    def compute(rows: DataFrame) -> float | None:
        classes = rows.select(F.max(F.size("chances"))).first()[0] or 0
        codes = [1] if classes == 2 else range(classes)
        found = [metric(rows, F.col("label") == c, F.get("chances", F.lit(c))) for c in codes]
        found = [v for v in found if v is not None]
        return sum(found) / len(found) if found else None

    return compute


for _name, _metric in {
    "log_loss": log_loss,
    "brier_score": brier_score,
    "roc_auc": over_classes(ranks.roc_auc),
    "average_precision": over_classes(ranks.average_precision),
}.items():
    register_metric(_name, _metric)


def _class_metric(name: str) -> Metric:
    return lambda rows: f1_scores(rows).first()[name]


for _name in (
    "accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted",
    "recall_weighted", "f1_weighted",
):
    register_metric(_name, _class_metric(_name))
