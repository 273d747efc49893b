"""Vocabulary, inverse document frequency and term weights."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiform.functions.stop_words import ENGLISH
from lexiform.functions.vectors import sparse_entries


def document_bound(bound: int | float, n_docs: int) -> float:
    """A bound on document frequency: floats are a share of the documents."""
    return bound * n_docs if isinstance(bound, float) else bound


def term_statistics(
    df: DataFrame, tokens: Column | str = "tokens", stop_words: Sequence[str] = ENGLISH
) -> DataFrame:
    """Corpus and document frequency of every term: term, tf, df.

    Both come out of one pass: each row is exploded once as it is and once
    without repeats, and counted inside the task before the shuffle. The outer
    explode keeps the optimiser from tokenising every text once more to drop
    empty ones beforehand.
    """
    bags = df.select(F.col(tokens).alias("_t") if isinstance(tokens, str) else tokens.alias("_t"))
    both = bags.select(
        F.posexplode_outer(F.array("_t", F.array_distinct("_t"))).alias("_unique", "_bag")
    )
    terms = both.select("_unique", F.explode_outer("_bag").alias("term"))
    terms = terms.filter(F.col("term").isNotNull())
    if stop_words:
        terms = terms.filter(~F.col("term").isin(list(stop_words)))
    return terms.groupBy("term").agg(
        F.sum(F.lit(1) - F.col("_unique")).cast("bigint").alias("tf"),
        F.sum("_unique").cast("bigint").alias("df"),
    )


def vocabulary(
    statistics: DataFrame,
    n_docs: int,
    max_features: int | None = 10_000,
    min_df: int | float = 1,
    max_df: int | float = 1.0,
) -> DataFrame:
    """The chosen terms with their frequencies: term, tf, df, n_docs.

    Terms outside the bounds go first, then the ``max_features`` most frequent
    stay, ties in alphabetical order. The same statistics serve any bounds.
    """
    lowest, highest = document_bound(min_df, n_docs), document_bound(max_df, n_docs)
    if highest < lowest:
        raise ValueError("max_df corresponds to fewer documents than min_df")
    kept = statistics.filter(F.col("df").between(lowest, highest))
    if max_features is not None:
        kept = kept.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)
    return kept.withColumn("n_docs", F.lit(n_docs).cast("bigint"))


def idf(use_idf: bool = True, smooth_idf: bool = True) -> Column:
    """Inverse document frequency from the columns df and n_docs."""
    if not use_idf:
        return F.lit(1.0)
    if smooth_idf:
        return F.log((F.col("n_docs") + 1) / (F.col("df") + 1)) + 1
    return F.log(F.col("n_docs") / F.col("df")) + 1


def vocabulary_lists(chosen: DataFrame, **weighting) -> tuple[list[str], list[float]]:
    """Terms in alphabetical order and their idf, for the driver.

    At most ``max_features`` rows come to the driver.
    """
    rows = chosen.select("term", idf(**weighting).alias("idf")).collect()
    if not rows:
        raise ValueError("no terms remain: relax min_df and max_df or the stop words")
    rows.sort(key=lambda row: row["term"])
    return [row["term"] for row in rows], [row["idf"] for row in rows]


def long_form(
    df: DataFrame,
    terms: Sequence[str],
    identifier: str = "doc_id",
    features: str = "features",
    value: str = "value",
) -> DataFrame:
    """Stored entries of sparse features as rows: identifier, term, value.

    The terms are bounded by ``max_features``, so the lookup is broadcast.
    """
    lookup = df.sparkSession.createDataFrame(
        pa.table({"index": pa.array(range(len(terms)), pa.int32()), "term": list(terms)})
    )
    exploded = df.select(identifier, F.explode_outer(sparse_entries(features)).alias("_e"))
    entries = exploded.filter(F.col("_e").isNotNull()).select(
        identifier, F.col("_e.index").alias("index"), F.col("_e.value").alias(value)
    )
    return entries.join(F.broadcast(lookup), "index").select(identifier, "term", value)
