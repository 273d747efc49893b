"""Quality rules whose cutoffs are chosen by a guarantee on false rejections.

Labelled good documents are the holdout. For every stratum and rule the cutoffs of a fixed ladder
are tested from the mildest to the strictest: a cutoff passes if the exact binomial upper bound
(Clopper-Pearson) on the share of good documents it rejects is within the rule's risk. Testing along
a fixed order stops at the first failure and so needs no correction along a ladder; the ladders of
all strata and rules share the error by Bonferroni, and the rules of a stratum share its risk. With
probability 1 - error, no stratum loses more than ``risk`` of its good documents.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiform.cluster import checkpointed, join_dimension
from lexiform.llm.text_stats import measure

RISK = 0.05  # good documents of a stratum that may be lost, all rules together
ERROR = 0.05  # chance that some stratum loses more
MAX_STRATA = 10_000  # more distinct strata are refused
NO_CUTOFF = 1 << 40

# Rule: numerator, denominator, cutoffs per thousand from mild to strict. A document is rejected if
# 1000 * numerator >= cutoff * denominator and the denominator is not 0.
RULES: dict[str, tuple[str, str, list[int]]] = {
    "symbols": ("n_symbols", "n_words", [2000, 1500, 1000, 700, 500, 400, 300, 250, 200]),
    "capitals": ("n_upper", "n_letters", [950, 900, 850, 800, 700, 600, 500]),
    "dup_lines": ("n_dup_lines", "n_lines", [900, 800, 700, 600, 500, 400, 300]),
    "repeats": ("n_repeat_words", "n_words", [290, 280, 270, 260, 250, 220, 200, 180, 150]),
    "long_words": ("word_chars", "n_words", [40000, 30000, 25000, 20000, 16000]),
}


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial with n trials of probability p."""
    if k >= n:
        return 1.0
    # Sum the tail that lies on k's side of the mean, from its largest term on.
    below = k < n * p
    j = k if below else k + 1
    term = math.exp(
        math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
        + j * math.log(p) + (n - j) * math.log1p(-p)
    )
    total = 0.0
    while 0 <= j <= n and term > total * 1e-17:
        total += term
        if below:
            term *= j * (1 - p) / ((n - j + 1) * p)
            j -= 1
        else:
            term *= (n - j) * p / ((j + 1) * (1 - p))
            j += 1
    return min(1.0, total if below else 1 - total)


def upper_bound(k: int, n: int, error: float) -> float:
    """The exact upper confidence bound on a probability after k of n."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if middle < 1 and at_most(k, n, middle) > error:
            low = middle
        else:
            high = middle
    return high


def violates(rule: str, cutoff) -> F.Column:
    numerator, denominator, _ = RULES[rule]
    return (F.col(denominator) > 0) & (
        F.col(numerator) * 1000 >= F.lit(cutoff) * F.col(denominator)
    )


def choose_cutoffs(
    measured: DataFrame, good: DataFrame, key: str, risk: float = RISK, error: float = ERROR
) -> DataFrame:
    """One row per stratum of the good documents: n_good, and a cutoff (or null) and bound per rule."""
    labelled = measured.join(good, key, "left_semi")
    counts = [
        F.sum(violates(rule, cutoff).cast("long")).alias(f"{rule}_{cutoff}")
        for rule, (_, _, ladder) in RULES.items()
        for cutoff in ladder
    ]
    found = (
        labelled.groupBy("stratum")
        .agg(F.count("*").alias("n_good"), *counts)
        .limit(MAX_STRATA + 1)
        .collect()
    )
    if len(found) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    rows = []
    for row in found:
        chosen = [row["stratum"], row["n_good"]]
        for rule, (_, _, ladder) in RULES.items():
            passed, bound = None, None
            for cutoff in ladder:
                k = row[f"{rule}_{cutoff}"]
                if at_most(k, row["n_good"], risk / len(RULES)) > error / (
                    len(found) * len(RULES)
                ):
                    break
                passed = cutoff
                bound = upper_bound(k, row["n_good"], error / (len(found) * len(RULES)))
            chosen += [passed, bound]
        rows.append(tuple(chosen))
    fields = ", ".join(f"{rule} long, {rule}_bound double" for rule in RULES)
    return measured.sparkSession.createDataFrame(rows, f"stratum string, n_good long, {fields}")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    good_label: str = "quality",
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """Per document its counts, base_failed, kept and the names of the rules it violates.

    A document is a good holdout if its lowest label is 1; null labels and documents without a
    label or with a null key take no part. A null stratum is the empty one. Strata without enough
    good documents have no cutoffs: there only the base rules reject. A null text is empty and fails
    the base rules. Repeated rows are judged each. Extra columns are not read.
    """
    measured = checkpointed(
        measure(docs, key, text, {"stratum": stratum})
        .withColumn("stratum", F.coalesce(F.col("stratum").cast("string"), F.lit("")))
        .withColumn("n_letters", F.col("n_upper") + F.col("n_lower"))
    )
    good = (
        labels.filter(F.col(good_label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key))
        .agg(F.min(good_label).alias("lowest"))
        .filter("lowest = 1")
        .select(key)
    )
    cutoffs = choose_cutoffs(measured, good, key, risk, error)
    joined = join_dimension(measured, cutoffs.select("stratum", *RULES), "stratum")
    broken = [F.when(F.coalesce(violates(r, F.col(r)), F.lit(False)), F.lit(r)) for r in RULES]
    failed = (F.col("n_words") < 20) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * 30
    )
    return joined.withColumns(
        {"base_failed": failed, "violated": F.array_compact(F.array(*broken))}
    ).withColumn("kept", ~F.col("base_failed") & (F.size("violated") == 0))
