"""Scoring and embedding streams of texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexiform.functions.text import tokenize_whitespace
from lexiform.operators.pooling import mean_pool
from lexiform.plans.models import NeighbourModel
from lexiform.plans.runs import FittedRun, score_text
from lexiform.plans.stages import TermTableModel

# Stages that look at a batch as a whole: they join it with a table of their own.
TABLE_STAGES = (NeighbourModel, TermTableModel)


def score_stream(
    fitted: FittedRun, texts: DataFrame, output: str, checkpoint: str, keep_running: bool = False
) -> StreamingQuery:
    """Write scored texts as Parquet, exactly once per input row.

    By default the query takes what is there and stops. Row-wise models score
    the stream itself and keep no state. Neighbours, and terms without a bound,
    meet each batch with their table; see ``by_batches``.
    """
    stages = [s for stage in fitted.model.stages for s in getattr(stage, "stages", [stage])]
    if any(isinstance(stage, TABLE_STAGES) for stage in stages):
        return by_batches(
            texts, lambda batch: score_text(fitted, batch), output, checkpoint, keep_running
        )
    writer = (
        score_text(fitted, texts)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if not keep_running:
        writer = writer.trigger(availableNow=True)
    return writer.start(output)


def pool_stream(
    texts: DataFrame,
    vectors: DataFrame,
    size: int,
    output: str,
    checkpoint: str,
    identifier: str = "doc_id",
    text: str = "text",
    keep_running: bool = False,
) -> StreamingQuery:
    """Write the mean vectors of a stream of texts over a table of word vectors (word, vector)."""

    def pool(batch: DataFrame) -> DataFrame:
        bags = batch.select(identifier, tokenize_whitespace(F.col(text)).alias("tokens"))
        return mean_pool(bags, vectors, size, identifier)

    return by_batches(texts, pool, output, checkpoint, keep_running)


def by_batches(
    rows: DataFrame,
    apply: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    keep_running: bool = False,
) -> StreamingQuery:
    """Write ``apply`` of every batch to a folder named after the batch.

    A batch that is repeated after a failure has the same rows and number and
    overwrites what it left, so that each row is written exactly once. Read the
    result with ``read_batches``.
    """

    def write(batch: DataFrame, number: int) -> None:
        apply(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if not keep_running:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_batches(spark, output: str) -> DataFrame:
    """What ``by_batches`` wrote, without the number of the batch."""
    return spark.read.parquet(output).drop("batch")
