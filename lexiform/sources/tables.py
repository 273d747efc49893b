"""Labelled text from Parquet files, tables or any DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def integer_code(column: str) -> Column:
    """A class code as an integer, fraction cut off; anything else is an error."""
    value = F.col(column)
    number = value.try_cast("double")
    unusable = value.isNotNull() & (number.isNull() | F.isnan(number))
    problem = F.concat(F.lit(f"{column} is not a number: "), value.cast("string"))
    return F.when(unusable, F.raise_error(problem)).otherwise(number).cast("int")


def standardize(
    df: DataFrame, text_column: str, target_column: str, id_column: str = "doc_id"
) -> DataFrame:
    """Any table as doc_id, text, target, without rows that lack text or target."""
    return df.na.drop("any", subset=[text_column, target_column]).select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        integer_code(target_column).alias("target"),
    )


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without a null in any column."""
    return df.na.drop("any")


def load_table(
    spark: SparkSession,
    path: str | None = None,
    table: str | None = None,
    text_column: str = "text",
    target_column: str = "target",
    id_column: str = "doc_id",
    format: str = "parquet",
) -> DataFrame:
    """Labelled text from a catalog table or from files of a columnar format."""
    if (path is None) == (table is None):
        raise ValueError("give either path or table")
    df = spark.table(table) if table else spark.read.format(format).load(path)
    return standardize(df, text_column, target_column, id_column)
