"""Where shared files go, and how small tables are told from large ones."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# A table of at most this many rows may be held by the driver and broadcast.
DIMENSION_ROWS = 100_000
# Rows of a table that a task gets when the table is dealt out anew.
SPREAD_ROWS = 50_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by spark.checkpoint.dir."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lexiform-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and cut the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(scan: DataFrame, identifier: str) -> DataFrame:
    """Give a scan that is one partition a partition per core; others stay as they are.

    A single partition is a file that cannot be split further, as quoted texts over
    several lines. For plain scans only: asking for the number of partitions would
    run the shuffles of anything else.
    """
    if scan.rdd.getNumPartitions() > 1:
        return scan
    return scan.repartition(scan.sparkSession.sparkContext.defaultParallelism, identifier)


def spread_groups(scan: DataFrame) -> DataFrame:
    """Deal out a scan of Parquet whose rows lie in a few row groups; others stay as they are.

    A file is split by its bytes, but a row group is read by one task whole: the rest of a file's
    partitions are empty. Rows by partition are counted from the files' footers. Rows are dealt by
    all their columns, so repeated or null ids do not meet in one task.
    """
    part = scan.select(F.spark_partition_id().alias("_part"))
    sizes = [row["count"] for row in part.groupBy("_part").count().collect()]
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if not sizes or max(sizes) <= 2 * math.ceil(sum(sizes) / cores):
        return scan
    return scan.repartition(max(cores, math.ceil(sum(sizes) / SPREAD_ROWS)), *scan.columns)


def settled(df: DataFrame, max_rows: int = DIMENSION_ROWS) -> tuple[DataFrame, bool]:
    """Evaluate a table once: a local relation if small, else a checkpoint.

    Returns the table and whether it is small enough to broadcast.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        return local_table(df.sparkSession, rows, df.schema), True
    return checkpointed(df), False


def sized(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """Like settled, for tables too large to pass through the driver."""
    table = checkpointed(df)
    return table, table.count() <= max_rows


def local_table(spark: SparkSession, rows: list[Row], schema: StructType) -> DataFrame:
    """Rows held by the driver as a local relation, whose size the optimiser knows."""
    held = [row.asDict(recursive=True) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(held, to_arrow_schema(schema)), schema)


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: str | list[str],
    how: str = "left",
    max_rows: int = DIMENSION_ROWS,
) -> DataFrame:
    """Join a table that is expected to be small.

    It is broadcast only when its counted size allows; beyond that the join is
    a plain one, left to adaptive execution and its skew handling.
    """
    dimension, small = settled(dimension, max_rows)
    return facts.join(F.broadcast(dimension) if small else dimension, on, how)


def block_pairs(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    reduce_pair: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str | StructType,
    block_rows: int,
    counts: tuple[int, int] | None = None,
) -> DataFrame:
    """Let every left row meet every right row, as pairs of bounded blocks.

    Ids are hashed to blocks, so a block holds about ``block_rows`` rows however
    skewed the data. ``reduce_pair`` returns a summary of one pair of blocks.
    """
    n_left, n_right = counts or (left.count(), right.count())
    left_blocks = max(1, math.ceil(n_left / block_rows))
    right_blocks = max(1, math.ceil(n_right / block_rows))

    def block(column: str, blocks: int):
        return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")

    def every(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    lefts = left.withColumn("_lb", block(left_id, left_blocks)).withColumn(
        "_rb", every(right_blocks)
    )
    rights = right.withColumn("_rb", block(right_id, right_blocks)).withColumn(
        "_lb", every(left_blocks)
    )
    return (
        lefts.groupBy("_lb", "_rb")
        .cogroup(rights.groupBy("_lb", "_rb"))
        .applyInPandas(lambda a, b: reduce_pair(a, b), schema)
    )
