import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiform.functions.text import tokenize_whitespace, tokenize_words
from lexiform.operators import embed, pooling, scale, terms, vectorize
from lexiform.plans.stages import (
    PopulationScaler, SublinearCounts, TermFeatures, TextEncoder, WordVectors, sequence_of,
)

DOCS = [(1, "aa bb aa"), (2, "aa cc cc"), (3, "aa cc")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string")


def chosen(docs, **bounds):
    statistics = vectorize.term_statistics(docs, tokenize_words("text"))
    return vectorize.vocabulary(statistics, docs.count(), **bounds)


def test_vocabulary_bounds(docs):
    kept = [(r["term"], r["tf"], r["df"]) for r in chosen(docs, max_df=0.8).collect()]
    assert kept == [("cc", 3, 2), ("bb", 1, 1)]
    assert chosen(docs, max_df=1.0).count() == 3
    assert chosen(docs, max_df=1).count() == 1
    assert [r["term"] for r in chosen(docs, max_features=1).collect()] == ["aa"]
    assert chosen(docs, min_df=0.5).count() == 2
    with pytest.raises(ValueError, match="max_df"):
        chosen(docs, min_df=3, max_df=0.5)


def test_idf(docs):
    rows = chosen(docs).select(
        "term", vectorize.idf().alias("smooth"), vectorize.idf(smooth_idf=False).alias("plain")
    ).collect()
    values = {r["term"]: (r["smooth"], r["plain"]) for r in rows}
    assert values["aa"] == (1.0, 1.0)
    assert math.isclose(values["bb"][0], math.log(2) + 1)
    assert math.isclose(values["bb"][1], math.log(3) + 1)


def test_weights_by_hand(spark, docs, tmp_path):
    fitted = TermFeatures(tfidf=True, sublinearTf=True).fit(docs)
    fitted.write().overwrite().save(f"{tmp_path}/features")
    again = PipelineModel.load(f"{tmp_path}/features")
    extra = spark.createDataFrame([(9, ""), (10, "the and of"), (11, None)], docs.schema)
    for model in (fitted, again):
        rows = {r["doc_id"]: r["features"].toArray() for r in model.transform(docs.union(extra)).collect()}
        idf = [1.0, math.log(4 / 2) + 1, math.log(4 / 3) + 1]
        raw = np.array([(1 + math.log(2)) * idf[0], idf[1], 0.0])
        assert np.allclose(rows[1], raw / np.linalg.norm(raw))
        for empty in (9, 10, 11):
            assert (rows[empty] == 0).all()


def test_several_columns_and_no_terms(spark, docs):
    two = docs.withColumn("more", F.lit("zz"))
    counts = TermFeatures(include=["text", "more"]).fit(two).transform(two)
    assert counts.filter("doc_id = 1").first()["features"].toArray().tolist() == [2.0, 1.0, 0.0, 1.0]
    assert "_tokens" not in counts.columns
    with pytest.raises(ValueError, match="no terms"):
        TermFeatures().fit(spark.createDataFrame([(1, "the")], docs.schema))


def test_shared_statistics(docs):
    features = TermFeatures(maxFeatures=2)
    features.statistics = features.term_statistics(docs), 3
    stage = features.fit(docs).stages[2]
    assert stage.vocabulary == ["aa", "cc"]


def test_pooling(spark):
    vectors = spark.createDataFrame([("aa", [2.0, 0.0]), ("bb", [0.0, 4.0])], "word string, vector array<double>")
    docs = spark.createDataFrame(
        [(1, "aa zz"), (2, "zz yy"), (3, "aa aa bb"), (4, "")], "doc_id bigint, text string"
    )
    bags = docs.select("doc_id", tokenize_whitespace("text").alias("tokens"))
    expected = {1: ([2.0, 0.0], 1), 2: ([0.0, 0.0], 0), 3: ([4 / 3, 4 / 3], 3), 4: ([0.0, 0.0], 0)}

    def check():
        pooled = pooling.mean_pool(bags, vectors, 2)
        for row in pooled.collect():
            values, known = expected[row["doc_id"]]
            assert np.allclose(row["embedding"], values) and row["n_known"] == known

    check()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pooling, "BROADCAST_NUMBERS", 2)
        check()


def test_word_vectors_stage_equals_join(spark, reviews):
    fitted = WordVectors(vectorSize=8, minCount=2, epochs=2, partitions=1).fit(reviews)
    fresh = spark.createDataFrame([(1, "good unseen food"), (2, "unseen")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r["features"].toArray() for r in fitted.transform(fresh).collect()}
    model = next(s for s in fitted.stages if hasattr(s, "getVectors"))
    joined = {r["doc_id"]: r["embedding"] for r in pooling.word2vec_embed(fresh, model).collect()}
    assert np.allclose(rows[1], joined[1], atol=1e-6) and (rows[2] == 0).all()


def test_encoder_holds_few_texts_at_a_time(spark, monkeypatch):
    from lexiform.functions import text

    monkeypatch.setattr(embed, "SLICE_CHARS", 8)
    monkeypatch.setattr(text, "SLICE_CHARS", 8)
    texts = ["one two", "", "three four five", "one", "two one"]
    assert [len(part) for part in text.text_slices(pa.array([*texts, None]))] == [2, 1, 1, 2]
    seen = []

    def few(size):
        make = embed.hashing_encoder(size)
        return lambda batch: seen.append(len(batch)) or make(batch)

    whole = few(8)(texts)
    assert seen == [5]  # one call, whose words are added up slice by slice
    monkeypatch.setattr(embed, "SLICE_CHARS", 1_000_000)
    assert (whole == embed.hashing_encoder(8)(texts)).all()


def test_encoder_calls_are_bounded(spark):
    """A call of the encoder gets about a million characters, however many rows a batch has."""
    many = spark.range(0, 400, 1, 1).select("id", F.expr("repeat('word ', 2000)").alias("text"))

    def counting():
        return lambda texts: np.full((len(texts), 1), float(sum(map(len, texts))))

    most = embed.embed_text(many, counting).agg(F.max(F.get("embedding", 0)), F.count("*")).first()
    assert most[0] <= 1_000_000 and most[1] == 400


def test_sublinear_counts_of_dense_and_sparse_rows(spark):
    rows = [(1, Vectors.sparse(3, {0: 1.0, 2: 4.0})), (2, Vectors.dense([0.0, 2.0])),
            (4, Vectors.sparse(3, {}))]
    made = SublinearCounts(inputCol="v", outputCol="w").transform(
        spark.createDataFrame(rows, ["id", "v"])
    )
    found = {r["id"]: r["w"] for r in made.collect()}
    assert found[1] == Vectors.sparse(3, {0: 1.0, 2: 1.0 + math.log(4)})
    assert found[2] == Vectors.dense([0.0, 1.0 + math.log(2)])
    assert found[4] == Vectors.sparse(3, {})


def test_scaler(spark):
    train = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "features array<double>")
    other = spark.createDataFrame([([5.0, 7.0],)], "features array<double>")
    assert [r["scaled"] for r in scale.standardize_features(train).collect()] == [[-1.0, 0.0], [1.0, 0.0]]
    fitted = PopulationScaler().fit(train)
    assert fitted.transform(other).first()["scaled"].toArray().tolist() == [3.0, 2.0]


def test_encoder(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "two one")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r["embedding"] for r in embed.embed_text(docs).collect()}
    assert rows[1] == rows[3] and sum(map(abs, rows[2])) == 0
    assert math.isclose(sum(x * x for x in rows[1]), 1.0)
    stage = sequence_of([TextEncoder(size=16)]).fit(docs).transform(docs)
    assert stage.first()["features"].size == 16


def test_failing_batches(spark):
    docs = spark.range(6).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text")).coalesce(1)

    def make():
        def encode(texts):
            if "t2" in texts:
                raise RuntimeError("service unavailable")
            return np.ones((len(texts), 4))

        return encode

    rows = embed.embed_text_batched(docs, make, size=4, batch_size=2).orderBy("doc_id").collect()
    assert [r["embed_ok"] for r in rows] == [True, True, False, False, True, True]
    assert rows[2]["embedding"] == [0.0] * 4 and rows[5]["embedding"] == [1.0] * 4


def test_empty_sequence():
    with pytest.raises(ValueError):
        sequence_of([])


def test_all_terms_equal_the_bounded_vocabulary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(terms, "RANGE_TERMS", 7)
    monkeypatch.setattr(terms, "FREQUENT_TERMS", 3)
    words = [f"w{i:02d}" for i in range(30)]
    rows = [(i, " ".join(words[(i * j) % 30] for j in range(1, 12))) for i in range(40)]
    rows += [(90, None), (91, ""), (92, "the of and"), (93, "unheard")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    train = frame.filter("doc_id < 92")
    for settings in ({}, {"tfidf": True, "sublinearTf": True}, {"tfidf": True, "minDF": 3}):
        bounded = TermFeatures(**settings).fit(train)
        fitted = TermFeatures(maxFeatures=None, **settings).fit(train)
        fitted.write().overwrite().save(f"{tmp_path}/all")
        wanted = {r["doc_id"]: r["features"] for r in bounded.transform(frame).collect()}
        for model in (fitted, PipelineModel.load(f"{tmp_path}/all")):
            made = {r["doc_id"]: r["features"] for r in model.transform(frame).collect()}
            assert made.keys() == wanted.keys()
            for key, vector in made.items():
                assert vector.size == wanted[key].size
                assert np.allclose(vector.toArray(), wanted[key].toArray())


def test_term_numbers_are_alphabetical(spark, monkeypatch):
    monkeypatch.setattr(terms, "RANGE_TERMS", 3)
    frame = spark.createDataFrame([(1, "bb aa cc dd ee ff gg aa zz yy")], "doc_id bigint, text string")
    statistics = vectorize.term_statistics(frame, tokenize_words("text"))
    made = terms.numbered_terms(statistics, 1).orderBy("index").collect()
    assert [(r["index"], r["term"]) for r in made] == list(
        enumerate(["aa", "bb", "cc", "dd", "ee", "ff", "gg", "yy", "zz"])
    )
    assert made[0]["tf"] == 2


def test_each_text_is_encoded_once(spark, monkeypatch):
    monkeypatch.setattr(embed, "COPIES", 5)
    rows = [(i, f"text {i % 7}" if i % 5 else "hot", i) for i in range(200)] + [(900, None, 0), (901, "", 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, embedding int").repartition(4)
    seen = spark.sparkContext.accumulator(0)

    def counting():
        encode = embed.hashing_encoder(8)

        def run(texts):
            seen.add(len(texts))
            return encode(texts)

        return run

    plain = {r["doc_id"]: r["embedding"] for r in embed.embed_text(frame, lambda: embed.hashing_encoder(8)).collect()}
    made = embed.embed_text(frame, counting, once=True)
    assert made.columns == ["doc_id", "text", "embedding"]
    assert {r["doc_id"]: r["embedding"] for r in made.collect()} == plain
    assert seen.value == 9  # seven texts, the hot one, and one that is empty
    batched = embed.embed_text_batched(frame, counting, size=8, batch_size=3, once=True)
    assert {r["doc_id"]: r["embedding"] for r in batched.collect()} == plain
    assert seen.value == 18 and batched.filter("embed_ok").count() == 202
