"""Starting streams, and state that lives between micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.runtime import scratch_path


def drain(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
) -> None:
    """Run over everything that has arrived, write Parquet files, stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def drain_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> None:
    """The same with one call of ``handle(batch, batch_id)`` per micro-batch."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def print_stream(stream: DataFrame, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Rows on the console, for looking at a stream."""
    return (
        stream.writeStream.format("console")
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .start()
    )


class BatchState:
    """A small table carried from micro-batch to micro-batch. The state after
    batch ``n`` has its own folder, so a batch that is run again starts from the
    same state and overwrites its own result only."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def before(self, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch_id - 1}")

    def save(self, state: DataFrame, batch_id: int) -> None:
        state.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def write_named(batch: DataFrame, batch_id: int, path: str, tag: str = "tag") -> None:
    """All named outputs of a micro-batch in one pass."""
    batch.write.mode("overwrite").partitionBy(tag).parquet(f"{path}/batch={batch_id}")


def end_of_input(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """One row, null but for a time ``seconds`` after the last of ``df``. As the
    last arrival of a stream it moves the watermark over every window that holds
    a row, if ``seconds`` is the length of a window plus the allowed disorder.
    Its own windows stay open, so it is in no result."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    end = df.agg((F.max(ts) + F.expr(f"INTERVAL {int(seconds)} SECONDS")).alias(ts))
    return end.select(
        *[(F.col(c) if c == ts else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]
    )


def replay(
    spark: SparkSession,
    df: DataFrame,
    order: str,
    cuts: Sequence[int],
    consume: Callable[[DataFrame, str], None],
    closing: DataFrame | None = None,
) -> None:
    """Feed a table to a stream in pieces that arrive one after the other.
    ``consume(stream, checkpoint)`` is called once per arrival with the same
    checkpoint, so each piece is a micro-batch of one continuing query. Rows of
    ``closing`` (see ``end_of_input``) arrive last."""
    folder, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "offsets")
    edges = [None, *cuts, None]
    for lo, hi in zip(edges, edges[1:]):
        piece = df
        if lo is not None:
            piece = piece.filter(F.col(order) >= lo)
        if hi is not None:
            piece = piece.filter(F.col(order) < hi)
        piece.write.mode("append").parquet(folder)
        consume(spark.readStream.schema(df.schema).parquet(folder), checkpoint)
    if closing is not None:
        closing.write.mode("append").parquet(folder)
        consume(spark.readStream.schema(df.schema).parquet(folder), checkpoint)
