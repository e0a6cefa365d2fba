"""S1-S3 for streams: subscribe to bar messages and decode them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.sources.codec import decode_bars, normalise_ts, split_quarantine


def bar_stream(spark: SparkSession, path: str | None = None, *, kafka_servers: str | None = None,
               topic: str = "ohlcv", starting_offsets: str = "earliest",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw messages with a ``value`` column.

    With ``kafka_servers`` the kafka source is used (needs the connector on the
    classpath); otherwise a folder of JSON-lines files, one message per line.
    Offsets start at ``earliest`` so bars published before the first trigger are
    not lost.
    """
    if kafka_servers:
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", kafka_servers)
                .option("subscribe", topic)
                .option("startingOffsets", starting_offsets)
                .load())
    if path is None:
        raise ValueError("path or kafka_servers is required")
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def parsed_bars(raw: DataFrame, default_symbol: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S2 + S3 + quarantine on a raw stream: (bars, dead letters)."""
    rows = normalise_ts(decode_bars(raw), default_symbol=default_symbol)
    good, bad = split_quarantine(rows)
    return good, bad.select(F.col("_text").alias("message"), "symbol", "ts", "close")
