"""Incremental variants over streams: micro-batches against state kept as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftwell.functions.ids import content_uuid
from siftwell.operators.references import merge_ledger


def first_arrivals(stream: DataFrame, content: str, time: str, delay: str = "1 hour") -> DataFrame:
    """The stream with a content id, later copies within the watermark dropped."""
    return stream.withColumn("content_id", content_uuid(F.col(content))).withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_id"])


def counts_per_window(stream: DataFrame, time: str, key: str, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """(start, key, n) per tumbling window; rows later than the watermark do not count."""
    counted = stream.withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), key, "n")


def maintain_ledger(deltas: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps a ledger of reference and existence counts up to date; the newest version is path/v=<batch>.

    A batch reads the version before its own and writes its own in full, so repeating it after a failure
    gives the same table.
    """

    def step(batch: DataFrame, number: int) -> None:
        state = batch.sparkSession.read.parquet(f"{path}/v={number - 1}") if number else None
        merge_ledger(state, batch).write.mode("overwrite").parquet(f"{path}/v={number}")

    return deltas.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
