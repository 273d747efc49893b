import hashlib
import math
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiform.operators import split, weights


def labels(spark, counts):
    rows = [(c * 10_000 + i, c) for c, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, target int")


def key(i, seed=42):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


def test_quotas(spark):
    quotas = {r["target"]: r["quota"] for r in split.stratified_quotas(labels(spark, {0: 7, 1: 3})).collect()}
    assert quotas == {0: 6, 1: 2}


@settings(max_examples=8, deadline=None)
@given(
    st.dictionaries(st.integers(0, 9), st.integers(2, 60), min_size=1, max_size=4),
    st.sampled_from([0.2, 0.33, 0.5]),
)
def test_quotas_by_largest_remainder(spark, counts, share):
    total = sum(counts.values())
    n_test = math.ceil(share * total)
    if min(n_test, total - n_test) < len(counts):
        return
    made = split.stratified_quotas(labels(spark, counts), test_size=share)
    quotas = {r["target"]: r["quota"] for r in made.collect()}
    exact = {c: Fraction(n * (total - n_test), total) for c, n in counts.items()}
    expected = {c: math.floor(q) for c, q in exact.items()}
    missing = total - n_test - sum(expected.values())
    for c in sorted(counts, key=lambda c: (expected[c] - exact[c], c))[:missing]:
        expected[c] += 1
    assert quotas == expected


@pytest.mark.parametrize("counts", [{0: 5, 1: 1}, {c: 2 for c in range(8)}])
def test_impossible_splits(spark, counts):
    with pytest.raises(Exception, match="fewer"):
        split.stratified_split(labels(spark, counts), test_size=0.2).collect()


@pytest.mark.parametrize("ranked", [1_000_000, 5])
def test_members(spark, monkeypatch, ranked):
    monkeypatch.setattr(split, "RANKED_ROWS", ranked)
    df = labels(spark, {0: 300, 1: 41, 2: 17})
    marked = {r["doc_id"]: (r["target"], r["split"]) for r in split.stratified_split(df).collect()}
    quotas = {r["target"]: r["quota"] for r in split.stratified_quotas(df).collect()}
    assert sum(quotas.values()) == 358 - 72
    for target, quota in quotas.items():
        members = sorted((i for i, (t, _) in marked.items() if t == target), key=key)
        assert all(marked[i][1] == "train" for i in members[:quota])
        assert all(marked[i][1] == "test" for i in members[quota:])


def test_sides_are_complete(spark):
    df = labels(spark, {0: 20, 1: 10}).withColumn("text", F.when(F.col("doc_id") != 3, "t"))
    train, test = split.train_test(df)
    assert train.count() + test.count() == 29
    assert set(train.columns) == {"doc_id", "target", "text"}


@pytest.mark.parametrize("ranked", [1_000_000, 5])
def test_shuffle(spark, monkeypatch, ranked):
    monkeypatch.setattr(split, "RANKED_ROWS", ranked)
    rows = split.shuffle_rows(labels(spark, {0: 500}), seed=7).collect()
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["position"])]
    assert order == sorted(range(500), key=lambda i: key(i, 7))
    assert [r["position"] for r in sorted(rows, key=lambda r: r["position"])] == list(range(1, 501))


def test_weights(spark):
    df = labels(spark, {0: 8, 1: 2})
    made = weights.class_weights(df)
    assert {r["target"]: r["weight"] for r in made.collect()} == {0: 0.625, 1: 2.5}
    rows = weights.with_class_weight(df, made.filter("target = 1")).collect()
    assert {(r["target"], r["weight"]) for r in rows} == {(0, 1.0), (1, 2.5)}
    copies = weights.with_copies(weights.with_class_weight(df, made), "weight", "doc_id")
    counts = {r["target"]: r["count"] for r in copies.groupBy("target").count().collect()}
    assert counts == {0: 8, 1: 8}


def test_large_dimension_is_not_broadcast(spark):
    from lexiform.cluster import join_dimension

    facts = spark.range(10).withColumnRenamed("id", "k")
    dimension = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = join_dimension(facts, dimension, "k", max_rows=3)
    assert {(r["k"], r["v"]) for r in joined.collect()} == {(i, 2 * i) for i in range(10)}
