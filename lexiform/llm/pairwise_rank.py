"""Rank documents by quality with a Bradley-Terry model of pairwise preferences.

A preference pair is a document labelled 1 and one labelled 0. The model gives every document the
score w.x, where w minimises the logistic loss of the differences x(preferred) - x(other). The
threshold is a quantile of the scores of all labelled documents: the share of them labelled 0. Only w
and the slope come from a bounded sample; the classes weigh in it as they do among all labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiform.cluster import checkpointed
from lexiform.llm.batches import remainder
from lexiform.llm.text_stats import measure

MAX_LABELLED = 20_000  # labelled documents of a class that the fit of the weights takes, by hash
MAX_PAIRS = 200_000  # preference pairs that it draws from them
HELD = 100_000  # scores around the threshold that the driver sorts
BINS = 1_024  # of a round that narrows the scores down to so many
THRESHOLD = 0.7  # the score that the threshold is mapped to
PENALTY = 1e-3


def features() -> dict[str, Column]:
    """Ratios of counts; none depends on anything but the text."""

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.col(a) / F.when(F.col(b) > 0, F.col(b)), F.lit(0.0))

    return {
        "words": F.log1p("n_words"),
        "few_words": (F.col("n_words") < 20).cast("double"),
        "word_length": F.least(ratio("word_chars", "n_words"), F.lit(30.0)),
        "symbols": F.sqrt(F.least(ratio("n_symbols", "n_words"), F.lit(4.0))),
        "capitals": ratio("n_upper", "n_letters"),
        "exclaims": F.sqrt(F.least(ratio("n_exclaims", "n_words"), F.lit(4.0))),
        "stops": F.least(ratio("n_stops", "n_words"), F.lit(2.0)),
        "digits": ratio("n_digits", "n_chars"),
        "dup_lines": ratio("n_dup_lines", "n_lines"),
        "repeats": ratio("n_repeat_words", "n_words"),
        "top_word": ratio("n_top_word", "n_words"),
        "variety": F.log1p("n_distinct_words") - F.log1p("n_words"),
        "line_words": F.log1p(ratio("n_words", "n_lines")),
    }


@dataclass
class RankModel:
    means: np.ndarray
    scales: np.ndarray
    weights: np.ndarray

    def raw(self, columns: list[str]) -> Column:
        raw = F.lit(0.0)
        for name, mean, scale, weight in zip(columns, self.means, self.scales, self.weights):
            raw = raw + (F.col(name) - float(mean)) * float(weight / scale)
        return raw

    def score(self, columns: list[str], threshold: float, slope: float) -> Column:
        """Between 0 and 1; THRESHOLD at the threshold."""
        z = (self.raw(columns) - threshold) * slope + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1.0 / (1.0 + F.exp(-z))


def logistic(rows: np.ndarray, signs: np.ndarray, penalty: float, weights=None) -> np.ndarray:
    """Newton's method for the mean logistic loss of signs * (rows @ w) with a ridge penalty."""
    w = np.zeros(rows.shape[1])
    weights = np.ones(len(rows)) if weights is None else weights
    weights = weights / weights.sum()
    for _ in range(50):
        margin = signs * (rows @ w)
        p = 1 / (1 + np.exp(np.clip(margin, -60, 60)))
        gradient = -(rows * (signs * p * weights)[:, None]).sum(0) + penalty * w
        curve = (rows * (p * (1 - p) * weights)[:, None]).T @ rows
        step = np.linalg.solve(curve + penalty * np.eye(len(w)), gradient)
        w -= step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(good: np.ndarray, bad: np.ndarray, totals: dict[int, int], seed: int = 7) -> RankModel:
    """Bradley-Terry weights from pairs of a good and a bad row."""
    both, weights = np.vstack([good, bad]), class_weights(good, bad, totals)
    means = np.average(both, axis=0, weights=weights)
    scales = np.sqrt(np.average((both - means) ** 2, axis=0, weights=weights))
    scales[scales < 1e-9] = 1.0
    good, bad = (good - means) / scales, (bad - means) / scales
    rng = np.random.default_rng(seed)
    n = min(MAX_PAIRS, 20 * (len(good) + len(bad)))
    differences = good[rng.integers(0, len(good), n)] - bad[rng.integers(0, len(bad), n)]
    return RankModel(means, scales, logistic(differences, np.ones(n), PENALTY))


def class_weights(good: np.ndarray, bad: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """Per row of the sample the labelled rows of its class that it stands for."""
    shares = [totals[1] / len(good), totals[0] / len(bad)]
    return np.repeat(shares, [len(good), len(bad)])


def fit_slope(
    model: RankModel, good: np.ndarray, bad: np.ndarray, totals: dict[int, int], threshold: float
) -> float:
    """Slope of the logistic curve through the threshold."""
    scores = (np.vstack([good, bad]) - model.means) / model.scales @ model.weights
    signs = np.concatenate([np.ones(len(good)), -np.ones(len(bad))])
    weights = class_weights(good, bad, totals)
    return float(max(logistic((scores - threshold)[:, None], signs, 1e-4, weights)[0], 1e-3))


def between(scores: DataFrame, rank: int) -> float:
    """Half way between the values at positions ``rank`` - 1 and ``rank`` of a sorted column ``raw``.

    Equal bins between the smallest and largest value left are counted, and the bin with the
    position is left, until the driver can sort it or it holds one value.
    """
    bounds = scores.agg(F.min("raw"), F.max("raw"), F.count("*")).first()
    low, high, n = bounds
    before = 0  # values smaller than low
    while n > HELD and low < high:
        place = F.floor((F.col("raw") - low) / ((high - low) / BINS))
        bins = (
            scores.filter(F.col("raw").between(low, high))
            .groupBy(F.least(place, F.lit(BINS - 1)).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high"))
            .orderBy("bin")
            .collect()
        )
        for row in bins:
            if before + row["n"] >= rank:
                low, high, n = row["low"], row["high"], row["n"]
                break
            before += row["n"]
    if low < high:
        left = scores.filter(F.col("raw").between(low, high)).toPandas()["raw"].to_numpy()
        value = float(np.sort(left)[rank - 1 - before])
    else:
        value = low
    after = scores.agg(
        F.count(F.when(F.col("raw") <= value, 1)), F.min(F.when(F.col("raw") > value, F.col("raw")))
    ).first()
    return value if after[0] > rank or after[1] is None else (value + after[1]) / 2


def rank(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    held_out: int = 2,
    of: int = 4,
    row: str | None = None,
) -> DataFrame:
    """Per document: key, held_out, score, predicted; with ``row`` also that column of its row.

    Documents whose crc32(key) modulo ``of`` is ``held_out`` are never learnt from. A document with
    several labels counts with its lowest; null labels and keys take no part. If a class has no
    document, every score is the share of label 1 (0.5 without labels). A null text is empty; it is
    scored like any other. Repeated rows are scored each.
    """
    columns = features()
    own = [row] if row else []
    measured = measure(docs, key, text, {r: r for r in own}).withColumn("n_letters", F.col("n_upper") + F.col("n_lower"))
    scored = checkpointed(measured.select(key, *own, *(c.alias(n) for n, c in columns.items())))
    known = (
        labels.filter(F.col(label).isNotNull() & (remainder(key, of) != held_out))
        .groupBy(F.col(key))
        .agg(F.min(label).alias("label"))
    )
    labelled = checkpointed(
        scored.join(known, key).filter(F.col("label").isin(0, 1)).select(key, "label", *columns)
    )
    totals = {0: 0, 1: 0}
    totals |= {int(r[0]): int(r[1]) for r in labelled.groupBy("label").count().collect()}

    def rows_of(value: int) -> np.ndarray:
        chosen = (
            labelled.filter(F.col("label") == value)
            .orderBy(F.xxhash64(key), key)
            .limit(MAX_LABELLED)
            .select(*columns)
        )
        return np.array([tuple(r) for r in chosen.collect()], dtype=float).reshape(-1, len(columns))

    if totals[0] and totals[1]:
        good, bad = rows_of(1), rows_of(0)
        model = fit(good, bad, totals)
        # As many are below the threshold as are labelled 0.
        threshold = between(labelled.select(model.raw(list(columns)).alias("raw")), totals[0])
        slope = fit_slope(model, good, bad, totals, threshold)
        score = model.score(list(columns), threshold, slope)
    else:
        score = F.lit(totals[1] / sum(totals.values()) if sum(totals.values()) else 0.5)
    apart = F.coalesce(remainder(key, of) == held_out, F.lit(False))
    return scored.select(key, *own, apart.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
