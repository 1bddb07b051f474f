"""The same operators over streams: resumable logs, first-wins dedupe and counts per window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_folder(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A folder to which files are added, as a stream; ``files_per_batch`` bounds the work of one batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def _timed(stream: DataFrame, ts: str) -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def first_wins(stream: DataFrame, keys: list[str], ts: str, lateness: str) -> DataFrame:
    """The first row of each key seen; state is dropped once the watermark has passed."""
    return _timed(stream, ts).withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)


def window_counts(stream: DataFrame, ts: str, size: str, lateness: str, by: list[str]) -> DataFrame:
    """(start, ...by, n): counts per tumbling window."""
    per = _timed(stream, ts).withWatermark(ts, lateness).groupBy(F.window(ts, size).alias("w"), *by).agg(F.count("*").alias("n"))
    return per.select(F.col("w.start").alias("start"), *by, "n")


def run_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"):
    """Process all that has arrived since the last run and stop: the checkpoint holds what is done, so a run that was
    broken off is resumed and nothing is done twice."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def observed(df: DataFrame, sink: Callable[[DataFrame], None], **metrics) -> dict:
    """Pass ``df`` to ``sink`` and return aggregates of the rows that went through, taken in the same pass."""
    from pyspark.sql import Observation

    seen = Observation()
    sink(df.observe(seen, *[c.alias(name) for name, c in metrics.items()]))
    return seen.get
