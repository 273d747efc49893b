"""Labelled-text sources, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiform.sources.corpus import load_category_corpus
from lexiform.sources.delimited import load_delimited
from lexiform.sources.tables import load_table

SOURCES = {
    "csv_file": load_delimited,
    "object_store_csv": load_delimited,
    "category_corpus": load_category_corpus,
    "table": load_table,
}


def load(spark: SparkSession, source: str, **options) -> DataFrame:
    """Labelled text from a named source: doc_id, text, target."""
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}, expected one of {sorted(SOURCES)}")
    return SOURCES[source](spark, **options)
