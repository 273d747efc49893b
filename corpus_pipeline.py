"""The document pipeline: quality, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of documents. Labels come
from ``sf_dir``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lexiform.cluster import fresh_path  # noqa: E402
from lexiform.llm import order_minhash, packing, pairwise_rank, toxicity  # noqa: E402
from lexiform.llm.queries import BYTE_VOCABULARY, table  # noqa: E402


def numbered(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents, written, with a number of each row, and that column's name."""
    row = "_row"
    while row in docs.columns:
        row += "_"
    folder = fresh_path(spark, "rows")
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(folder)
    return spark.read.parquet(folder), row


def without(rows: DataFrame, row: str, decisions: DataFrame, rejected) -> DataFrame:
    """Rows less those that a decision on the row itself rejects, whatever their ids."""
    return rows.join(decisions.filter(rejected).select(row), row, "left_anti").drop(row)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise quality model predicts to be good."""
    rows, row = numbered(spark, docs)
    ranked = pairwise_rank.rank(rows, table(spark, sf_dir, "labels"), row=row)
    return without(rows, row, ranked, F.col("predicted") == 0).select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not predict to be toxic."""
    rows, row = numbered(spark, docs)
    scored = toxicity.score_toxicity(rows, table(spark, sf_dir, "labels"), row=row)
    return without(rows, row, scored, F.col("predicted") == 1).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id.

    Classes are of texts, so rows that share an id only stay both. A null id is the smallest; of rows
    with equal ids one stays.
    """
    rows, row = numbered(spark, docs)
    found = order_minhash.near_duplicates(rows, key=row).select(row, "class_id")
    ids = rows.select(row, F.struct("doc_id", row).alias("_first"))
    first = found.join(ids, row).groupBy("class_id").agg(F.min("_first").alias("_first"))
    return rows.join(first.select(F.col(f"_first.{row}").alias(row)), row, "left_semi").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents as pieces of sequences."""
    return packing.pack_documents(docs, BYTE_VOCABULARY, end_id=0)


STAGES = [
    ("pairwise quality", keep_quality),
    ("Kneser-Ney toxicity", drop_toxic),
    ("Order MinHash near-dedup", drop_near_duplicates),
    ("best-fit packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            folder = fresh_path(spark, f"stage{number}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
