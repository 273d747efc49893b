"""Work is dealt over tasks, however the input lies in its files."""

import pandas as pd
import pytest
from pyspark.ml.feature import Word2Vec
from pyspark.sql import functions as F

from lexiform import catalog
from lexiform.functions.text import tokenize_whitespace
from lexiform.operators import pooling


def rows_by_task(df):
    counts = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return sorted(row["count"] for row in counts)


def test_one_row_group_is_dealt_out(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    rows = 200 * cores
    texts = [f"word{i} " * 20 + f"{i * 7919}" for i in range(rows)]
    ids = [None if i % 3 == 0 else i % 7 for i in range(rows)]  # nulls and repeats
    made = pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "text": texts})
    made.to_parquet(tmp_path / "documents.parquet", row_group_size=rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scan = catalog.table(spark, str(tmp_path), "documents").select("doc_id", "text")
        assert scan.rdd.getNumPartitions() > 1 and rows_by_task(scan) == [rows]
        dealt = catalog.documents_of(spark, str(tmp_path))
        shares = rows_by_task(dealt)
        assert sum(shares) == rows and max(shares) <= max(rows // 2, 2 * rows // cores)
        assert dealt.exceptAll(scan).isEmpty() and scan.exceptAll(dealt).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_word_vectors_bound_the_tokens_of_a_part(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "aa bb cc dd") for i in range(10)], "doc_id bigint, text string")
    model = pooling.word2vec_fit(docs, vector_size=2, partitions=2)
    assert model.getNumPartitions() == 2  # as given, while its parts are small
    monkeypatch.setattr(pooling, "TRAINING_TOKENS", 8)
    model = pooling.word2vec_fit(docs, vector_size=2, partitions=2)
    assert model.getNumPartitions() == 5
    assert {r["word"] for r in pooling.word_vectors(model).collect()} == {"aa", "bb", "cc", "dd"}
    trainer = Word2Vec(vectorSize=2, minCount=99, numPartitions=1, inputCol="tokens", outputCol="v")
    with pytest.raises(Exception):  # as the trainer itself
        pooling.train_in_parts(trainer, docs.select(tokenize_whitespace("text").alias("tokens")))


def test_more_tokens_make_more_parts_than_eight(spark):
    class Trainer:
        numPartitions = "numPartitions"

        def getInputCol(self):
            return "tokens"

        def getNumPartitions(self):
            return pooling.TRAINING_PARTITIONS

        def copy(self, extra):
            self.parts = extra[self.numPartitions]
            return self

        def fit(self, rows):
            return self

    bags = spark.range(240).selectExpr("array_repeat('a', 100000) AS tokens")
    assert pooling.train_in_parts(Trainer(), bags).parts == 12
    assert pooling.train_in_parts(Trainer(), bags.limit(1)).parts == 8
