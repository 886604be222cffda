"""Scoring a stream with the fitted chain (Z1 on Structured Streaming).

After ``fit`` every step is a projection or a join with a small static
state table, so the same ``FittedChain.transform`` applies unchanged to a
streaming DataFrame (stream-static joins) and keeps no streaming state.
Removing repeated rows (C9) does: ``dedup_stream`` remembers the rows seen
within a stated horizon, and nothing older.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """A file stream with an explicit schema (no inference on streams)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def dedup_stream(stream: DataFrame, event_time: str, horizon: str, keys: list[str] | None = None) -> DataFrame:
    """C9 on a stream: one of the rows that are equal in ``keys`` (every
    column by default), in whatever order and files they come.

    ``horizon`` (such as ``"2 hours"``) is the promise that bounds the state: a
    row comes at most so much event time behind the latest one seen, and so do
    its repeats.  Within it the result is that of the batch dedup; rows that
    come later are left out, as the state of their repeats is gone.  Rows
    without an event time are left out too.
    """
    timed = stream.where(stream[event_time].isNotNull()).withWatermark(event_time, horizon)
    return timed.dropDuplicatesWithinWatermark(list(keys) if keys else timed.columns)


def score_stream(stream: DataFrame, chain, sink_path: str, checkpoint: str, fmt: str = "parquet",
                 trigger_once: bool = True, watermark: tuple[str, str] | None = None,
                 dedup: tuple[str, str] | None = None) -> StreamingQuery:
    """Replay ``chain`` on every micro-batch and append to ``sink_path``;
    ``dedup`` (event time, horizon) first removes repeated rows.

    ``checkpoint`` must be a shared folder: the query restarts from it after
    a driver or executor loss.
    """
    scored = chain.transform(dedup_stream(stream, *dedup) if dedup else stream)
    if watermark:
        scored = scored.withWatermark(*watermark)
    w = (scored.writeStream.format(fmt).outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


def score_to_memory(stream: DataFrame, chain, name: str) -> StreamingQuery:
    """Local smoke path: score into an in-memory table ``name``."""
    return (chain.transform(stream).writeStream.format("memory").queryName(name)
            .outputMode("append").trigger(availableNow=True).start())
