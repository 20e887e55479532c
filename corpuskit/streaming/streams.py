"""Incremental counterparts of batch operators, on file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuskit.functions.text import dedup_key, low_quality


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


def flag_stream(stream: DataFrame, answer: str) -> DataFrame:
    return stream.withColumn("_low_quality_flag", low_quality(F.col(answer)))


def dedup_stream(stream: DataFrame, *columns: str, event_time: str | None = None, late: str = "30 days") -> DataFrame:
    """First row of each dedup key. With an event time, keys older than the watermark leave the state."""
    keyed = stream.withColumn("dedup_sha256", dedup_key(*[F.col(c) for c in columns]))
    if event_time:
        return keyed.withWatermark(event_time, late).dropDuplicatesWithinWatermark(["dedup_sha256"])
    return keyed.dropDuplicates(["dedup_sha256"])


def hourly_counts(stream: DataFrame, event_time: str, *by: str, late: str = "1 day") -> DataFrame:
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, "1 hour"), *by).agg(F.count(F.lit(1)).alias("n"))


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; a second call goes on where this one ended."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
