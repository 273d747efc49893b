"""Documents as the mean of their word vectors."""

from __future__ import annotations

import math

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiform.cluster import fresh_path, sized
from lexiform.functions.text import tokenize_whitespace
from lexiform.operators.skipgram import SkipGram, WordTable

# A word-vector table of at most this many numbers is broadcast.
BROADCAST_NUMBERS = 20_000_000
# Parts of the data that word vectors are trained on side by side, at least.
TRAINING_PARTITIONS = 8
# Tokens that a part may hold. A part is one task, so more tokens make more parts.
TRAINING_TOKENS = 2_000_000


def word2vec_fit(
    df: DataFrame,
    text: str = "text",
    vector_size: int = 100,
    window: int = 5,
    min_count: int = 1,
    epochs: int = 10,
    alpha: float = 0.025,
    partitions: int = TRAINING_PARTITIONS,
    seed: int = 42,
) -> WordTable:
    """Skip-gram word vectors of lower-case white-space tokens.

    ``partitions`` parts of the data are trained side by side, so the number is
    part of the model and does not follow the cluster. Beyond TRAINING_TOKENS
    tokens a part there are as many parts as hold them, trained in rounds that
    go on from each other.
    """
    bags = df.select(tokenize_whitespace(text).alias("tokens"))
    trainer = SkipGram(
        vectorSize=vector_size,
        windowSize=window,
        minCount=min_count,
        maxIter=epochs,
        stepSize=alpha,
        numPartitions=partitions,
        seed=seed,
        inputCol="tokens",
        outputCol="embedding",
    )
    return train_in_parts(trainer, bags)


def train_in_parts(trainer: Word2Vec, bags: DataFrame) -> WordTable | Word2VecModel:
    """Fit on token arrays, in the trainer's number of parts or as many as bound a part's tokens.

    The trainer reads its input twice, so the tokens are written once before.
    """
    tokens, spark = trainer.getInputCol(), bags.sparkSession
    folder = fresh_path(spark, "tokens")
    bags.select(tokens).write.parquet(folder)
    written = spark.read.parquet(folder)
    total = written.select(F.sum(F.size(tokens))).first()[0] or 0
    parts = max(trainer.getNumPartitions(), math.ceil(total / TRAINING_TOKENS))
    return trainer.copy({trainer.numPartitions: parts}).fit(written)


def word_vectors(model: WordTable | Word2VecModel) -> DataFrame:
    """The fitted words and their vectors: word, vector."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def mean_pool(
    df: DataFrame,
    vectors: DataFrame,
    size: int,
    identifier: str = "doc_id",
    tokens: str = "tokens",
    output: str = "embedding",
) -> DataFrame:
    """Mean vector of each document's known words: identifier, output, n_known.

    ``vectors`` holds word, vector (array). Documents without a known word get
    zeros. A word table of checked size is broadcast, and the sums are then
    taken inside the tasks before the one shuffle by document. A larger table
    is joined on the word: repeats within a document are counted first, so a
    frequent word costs one row per document, and adaptive execution splits
    what is still skewed.
    """
    side, small = sized(vectors.select("word", "vector"), max(1, BROADCAST_NUMBERS // size))
    words = df.select(identifier, F.explode_outer(tokens).alias("word"))
    if small:
        joined = words.withColumn("_n", F.lit(1)).join(F.broadcast(side), "word", "left")
    else:
        counted = words.groupBy(identifier, "word").agg(F.count("*").alias("_n"))
        joined = counted.join(side, "word", "left")
    known = F.sum(F.when(F.col("vector").isNotNull(), F.col("_n")).otherwise(0))
    sums = joined.groupBy(identifier).agg(
        known.alias("n_known"),
        *[F.sum(F.get("vector", i) * F.col("_n")).alias(f"_s{i}") for i in range(size)],
    )
    divisor = F.greatest(F.col("n_known"), F.lit(1))
    means = [F.coalesce(F.col(f"_s{i}") / divisor, F.lit(0.0)) for i in range(size)]
    return sums.select(identifier, F.array(*means).alias(output), "n_known")


def word2vec_embed(
    df: DataFrame,
    model: WordTable | Word2VecModel,
    identifier: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Documents as the mean of a fitted model's vectors over known words."""
    bags = df.select(identifier, tokenize_whitespace(text).alias("tokens"))
    return mean_pool(bags, word_vectors(model), model.getVectorSize(), identifier)
