"""Labelled text whose class is a category name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.cluster import join_dimension
from lexiform.operators.profile import ranked_codes
from lexiform.operators.split import shuffle_rows


def category_filter(df: DataFrame, categories: Sequence[str], column: str) -> DataFrame:
    """Rows of the listed categories."""
    return df.filter(F.col(column).isin(list(categories)))


def read_category_folders(spark: SparkSession, path: str, subset: str = "all") -> DataFrame:
    """One document per file below path/subset/category/: doc_id, text, category."""
    if subset not in ("train", "test", "all"):
        raise ValueError("subset must be train, test or all")
    files = spark.read.text(f"{path}/{'*' if subset == 'all' else subset}/*/*", wholetext=True)
    name = F.col("_metadata.file_path")
    parts = F.split(name, "/")
    return files.select(
        F.concat_ws("/", F.slice(parts, -3, 3)).alias("doc_id"),
        F.col("value").alias("text"),
        F.element_at(parts, -2).alias("category"),
    )


def load_category_corpus(
    spark: SparkSession,
    corpus: DataFrame | None = None,
    path: str | None = None,
    categories: Sequence[str] | None = None,
    subset: str = "train",
    subset_column: str | None = None,
    category_column: str = "category",
    text_column: str = "text",
    id_column: str = "doc_id",
    shuffle: bool = True,
    seed: int = 42,
) -> DataFrame:
    """A corpus as doc_id, text, target, target_name (and position if shuffled).

    ``corpus`` is a table with a category column; without it the documents are
    read from ``path``. The target is the rank of the category name among the
    chosen ones; ``categories=None`` takes all.
    """
    if corpus is None:
        corpus = read_category_folders(spark, path, subset)
        category_column, text_column, id_column = "category", "text", "doc_id"
    elif subset_column is not None and subset != "all":
        corpus = corpus.filter(F.col(subset_column) == subset)
    rows = corpus.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("text"),
        F.col(category_column).alias("target_name"),
    )
    if categories is not None:
        rows = category_filter(rows, categories, "target_name")
    codes = ranked_codes(rows, "target_name", "target")
    coded = join_dimension(rows, codes, "target_name", "inner").select(
        "doc_id", "text", "target", "target_name"
    )
    return shuffle_rows(coded, "doc_id", seed) if shuffle else coded
