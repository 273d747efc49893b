"""Documents as rows of term numbers when the vocabulary has no bound.

Nothing here is proportional to the vocabulary on the driver: terms are a table, numbered by range,
and documents meet them in a join. A fixed number of the most frequent terms is broadcast, since these
are the keys that would be skewed; the rest join by shuffle. Rows are assembled by document.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.cluster import checkpointed, fresh_path, settled
from lexiform.functions.text import sublinear
from lexiform.functions.vectors import bound
from lexiform.operators.vectorize import vocabulary

# Terms that are numbered by one task.
RANGE_TERMS = 500_000

# The most frequent terms, which are broadcast.
FREQUENT_TERMS = 10_000


def numbered_terms(
    statistics: DataFrame, n_docs: int, min_df: int | float = 1, max_df: int | float = 1.0
) -> DataFrame:
    """All terms within the bounds with their numbers in alphabetical order, from 0:
    term, tf, df, n_docs, index.

    Terms are dealt out by range; a task ranks its own, after the counts of the ranges before.
    """
    kept = checkpointed(vocabulary(statistics, n_docs, None, min_df, max_df))
    ranges = max(1, math.ceil(kept.count() / RANGE_TERMS))
    dealt = checkpointed(
        kept.repartitionByRange(ranges, "term").withColumn("_range", F.spark_partition_id())
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    starts, small = settled(starts)
    place = F.row_number().over(Window.partitionBy("_range").orderBy("term"))
    return (
        dealt.join(F.broadcast(starts) if small else starts, "_range")
        .withColumn("index", (F.col("_start") + place - 1).cast("bigint"))
        .drop("_range", "_start")
    )


def counted_tokens(tokens: Column | str) -> Column:
    """The tokens of a row and how often they occur: an array of (term, tf) in alphabetical order."""

    def runs(ordered: Column) -> Column:
        first = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return bound(
            first,
            lambda starts: F.transform(
                starts,
                lambda s, n: F.struct(
                    F.get(ordered, s).alias("term"),
                    (F.coalesce(F.get(starts, n + 1), F.size(ordered)) - s).alias("tf"),
                ),
            ),
        )

    return F.when(F.size(tokens) > 0, bound(F.array_sort(tokens), runs))


def encoded(
    df: DataFrame,
    terms: DataFrame,
    identifier: str = "doc_id",
    tokens: str = "tokens",
    value: Column | None = None,
) -> DataFrame:
    """Documents in terms of their numbers: identifier, indices, values.

    ``terms`` holds term, index and what ``value`` reads besides tf, which is the default. A
    document without any of the terms has empty arrays. Identifiers must be unique.
    """
    value = F.col("tf") if value is None else value
    spark = df.sparkSession
    frequent = terms.orderBy(F.desc("df"), "term").limit(FREQUENT_TERMS)
    frequent, _ = settled(frequent)
    bags = df.select(F.col(identifier).alias("_id"), F.explode_outer(counted_tokens(tokens)).alias("_c"))
    counts = bags.select("_id", F.col("_c.term").alias("term"), F.col("_c.tf").alias("tf"))
    # Written, so that texts are cut into tokens once; read again by whether the term was known.
    folder = fresh_path(spark, "tokens")
    counts.join(F.broadcast(frequent), "term", "left").write.parquet(folder)
    marked = spark.read.parquet(folder)
    unknown = marked.filter("index IS NULL AND term IS NOT NULL").select("_id", "term", "tf")
    rest = unknown.join(terms.join(F.broadcast(frequent.select("term")), "term", "left_anti"), "term")
    found = marked.filter("index IS NOT NULL").unionByName(rest)
    entry = F.struct(F.col("index"), value.cast("double").alias("value"))
    rows = found.groupBy("_id").agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    every = marked.filter("term IS NULL").select("_id").unionByName(unknown.select("_id"))
    empty = every.distinct().join(rows.select("_id"), "_id", "left_anti")
    none = empty.select("_id", F.array().cast(rows.schema["_entries"].dataType).alias("_entries"))
    return rows.unionByName(none).select(
        F.col("_id").alias(identifier),
        F.col("_entries.index").alias("indices"),
        F.col("_entries.value").alias("values"),
    )


def weighed(idf: Column, dampen: bool = False) -> Column:
    """A term's weight in a document: its count, or 1 + ln(count), times its idf."""
    return (sublinear("tf") if dampen else F.col("tf")) * idf


def sparse_vectors(size: int):
    """A function of indices and values to ML vectors of this size."""

    @F.arrow_udf(VectorUDT())
    def build(indices: pa.Array, values: pa.Array) -> pa.Array:
        rows = len(indices)
        return pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(rows, np.int8)),
                pa.array(np.full(rows, size, np.int32)),
                indices.cast(pa.list_(pa.int32())),
                values.cast(pa.list_(pa.float64())),
            ],
            names=["type", "size", "indices", "values"],
        )

    return build.asNondeterministic()  # or the optimiser repeats it for every use of the vector
