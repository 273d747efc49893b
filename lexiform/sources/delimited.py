"""Labelled text from delimited files on any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lexiform.cluster import spread
from lexiform.sources.tables import standardize

# Spellings that mean "no value" in a delimited file.
NULL_SPELLINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def load_delimited(
    spark: SparkSession,
    path: str = "dataset.csv",
    text_column: str = "customer_review",
    target_column: str = "return",
    sep: str = "\t",
    id_column: str | None = None,
    id_type: str = "bigint",
    multiline: bool = True,
    check_ids: bool = True,
) -> DataFrame:
    """A delimited file or folder of files as doc_id, text, target.

    The first column of the file is its row index and becomes doc_id, unless
    ``id_column`` names another. A quoted text may span lines; such a file is
    read by one task, so large data should come as many files, or with
    ``multiline=False`` if no text holds a line break. The rows of a single
    partition are spread over the cores for what follows.

    Every file must have the same header, in the same order, and every row as
    many fields as the header; anything else is an error when rows are read.
    Ids that occur twice, as the row indexes of several files would, are an
    error at once; that costs a pass over the ids, which ``check_ids=False``
    spares.
    """
    options = dict(sep=sep, header=True, quote='"', escape='"', multiLine=multiline)
    names = spark.read.csv(path, **options).columns
    # The index has an empty name in the file, which the reader otherwise replaces.
    fields = [StructField("" if c == f"_c{i}" else c, StringType()) for i, c in enumerate(names)]
    strict = spark.read.schema(StructType(fields)).option("columnPruning", False)
    raw = strict.csv(path, enforceSchema=False, mode="FAILFAST", **options).toDF(*names)
    id_column = id_column or raw.columns[0]
    missing = [c for c in (id_column, text_column, target_column) if c not in raw.columns]
    if missing:
        raise ValueError(f"columns not in {path}: {missing}")

    def value(name: str):
        return F.when(~F.col(name).isin(NULL_SPELLINGS), F.col(name)).alias(name)

    rows = raw.select(
        F.col(id_column).cast(id_type).alias("doc_id"),
        value(text_column),
        F.trim(value(target_column)).alias(target_column),
    )
    if check_ids:
        twice = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
        found = [row["doc_id"] for row in twice.limit(3).collect()]
        if found:
            raise ValueError(f"ids that occur more than once in {path}: {found}")
    return standardize(spread(rows, "doc_id"), text_column, target_column)


def save_delimited(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Write a table so that load_delimited reads the same values back."""
    df.write.csv(path, sep=sep, header=True, quote='"', escape='"', quoteAll=True)
