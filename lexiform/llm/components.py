"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lexiform.cluster import fresh_path
from lexiform.llm.batches import record_batch

# Links that a task finishes together. More are contracted in rounds until no more are left.
TOGETHER = 200_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of the links, null ends and loops left out.

    The component is the smallest node. A large star points every larger neighbour of a node to the
    smallest one, a small star every node and its smaller neighbours; both keep what is connected,
    and a few rounds leave a star around each smallest node. As soon as at most TOGETHER links with
    bigint ends are left, one task finishes them, as each round is many small shuffles. Nothing is
    collected; a node with very many neighbours is only a key of aggregates and of joins that
    adaptive execution may split.
    """
    spark = links.sparkSession
    kind = links.schema[a].dataType.simpleString()
    schema = f"u {kind}, v {kind}"

    def written(edges: DataFrame) -> DataFrame:
        folder = fresh_path(spark, "edges")
        edges.write.parquet(folder)
        return spark.read.schema(schema).parquet(folder)

    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")
    edges = written(
        pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
    )
    while True:
        if kind == "bigint" and edges.count() <= TOGETHER:
            edges = edges.coalesce(1).mapInArrow(_joined, EDGES)
            break
        if _stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .unionByName(  # a node's own link to its smallest neighbour
                least.filter("m < u").select("u", F.col("m").alias("v"))
            )
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        edges = written(small)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)


EDGES = StructType([StructField("u", LongType()), StructField("v", LongType())])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node but the smallest of its component, and that."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = node = parent[above]
        return node

    for batch in batches:
        for u, v in zip(*(c.to_pylist() for c in batch.columns)):
            x, y = root(u), root(v)
            parent[max(x, y)] = min(x, y)
    found = [(u, root(u)) for u in parent]
    columns = zip(*[(u, v) for u, v in found if u != v]) if found else ((), ())
    yield record_batch(EDGES, dict(zip("uv", map(list, columns))))


def _stars(edges: DataFrame) -> bool:
    """Whether every node points to one other at most, and never one that points on."""
    zero, one = F.lit(0), F.lit(1)
    ends = edges.select(F.col("u").alias("node"), one.alias("out"), zero.alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), zero.alias("out"), one.alias("into"))
    )
    sums = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return sums.filter("out > 1 OR (out = 1 AND into = 1)").isEmpty()
