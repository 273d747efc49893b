import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiform.functions import text, vectors
from lexiform.operators import columns


def test_patterns():
    names = ["a1", "a2", "b", "text"]
    assert columns.chosen_columns(names, ["a*", "a1", "zz"], ["a2"]) == ["a1"]
    assert columns.chosen_columns(names, ["*"], ["text"]) == ["a1", "a2", "b"]
    with pytest.raises(ValueError):
        columns.chosen_columns(names, ["a*"], ["*"])
    assert columns.feature_prefix(["a", "b"]) == "a_b"
    assert columns.feature_prefix(list("abcd")) == "features"


def test_joined_text_and_wide_vectors(spark):
    df = spark.createDataFrame([("x", None, 3)], "a string, b string, n int")
    assert columns.concat_text(df).first()["text"] == "x  3"
    wide = columns.expand_vector(spark.createDataFrame([([1.0, 2.0],)], "v array<double>"), "v")
    assert wide.columns == ["v", "v_0", "v_1"] and wide.first()["v_1"] == 2.0
    one = columns.expand_vector(spark.createDataFrame([(7.0,)], "v double"), "v")
    assert one.first()["v_0"] == 7.0
    with pytest.raises(Exception):
        columns.assemble_features(spark.createDataFrame([(1.0, None)], "a double, b double")).collect()


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression).first()[0]


def test_tokens(spark):
    assert one(spark, "A bee, çà_9 Ünï x", text.tokenize_words("x")) == ["bee", "çà_9", "ünï"]
    assert one(spark, None, text.tokenize_words("x")) == []
    assert one(spark, " A b\tC　d\x1ce ", text.tokenize_whitespace("x")) == list("abcde")
    assert one(spark, "Crème ﬁn Å", text.strip_accents("x")) == "Creme fin A"
    kept = text.remove_stop_words(F.array(F.lit("the"), F.lit("cat")), ["the"])
    assert one(spark, "", kept) == ["cat"]


def test_vector_expressions(spark):
    assert one(spark, [3.0, 4.0], vectors.l2_normalize("x"), "array<double>") == [0.6, 0.8]
    assert one(spark, [0.0, 0.0], vectors.l2_normalize("x"), "array<double>") == [0.0, 0.0]
    shares = one(spark, [1000.0, 1000.0], vectors.softmax("x"), "array<double>")
    assert shares == [0.5, 0.5]
    zero = F.array(F.lit(0.0), F.lit(0.0))
    for p, expected in ((1, 7.0), (2, 5.0), (3, (27 + 64) ** (1 / 3))):
        got = one(spark, [3.0, -4.0], vectors.minkowski_distance("x", zero, p), "array<double>")
        assert math.isclose(got, expected)


def test_decisions(spark):
    assert one(spark, [0.2, 0.4, 0.4], vectors.decide_class("x", "argmax"), "array<double>") == 1
    assert one(spark, 0.5, vectors.decide_class("x", "threshold"), "double") == 0
    assert one(spark, 0.6, vectors.decide_class("x", "score", 2), "double") == 1
    assert one(spark, 0.5, vectors.decide_class("x", "score", 3), "double") == 0
    assert one(spark, 3.0, vectors.decide_class("x", "score", 3), "double") == 3
    with pytest.raises(ValueError):
        vectors.decide_class("x", "guess")


def test_sparse_entries(spark):
    df = spark.createDataFrame(
        [(Vectors.sparse(5, [1, 3], [2.0, 4.0]),), (Vectors.dense([0.0, 7.0]),)], ["v"]
    )
    entries = [[tuple(e) for e in r[0]] for r in df.select(vectors.sparse_entries("v")).collect()]
    assert entries == [[(1, 2.0), (3, 4.0)], [(0, 0.0), (1, 7.0)]]
