"""S4 write side: publish encoded bars to a topic or to JSON-lines files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.sources.codec import encode_bars


def publish_bars(bars: DataFrame, path: str | None = None, *, kafka_servers: str | None = None,
                 topic: str = "ohlcv") -> None:
    """Batch publish. Kafka: key = symbol, value = JSON (needs the connector on
    the classpath). Files: one JSON message per line, appended under ``path``."""
    wire = encode_bars(bars)
    if kafka_servers:
        (wire.write.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
         .option("topic", topic).save())
        return
    if path is None:
        raise ValueError("path or kafka_servers is required")
    wire.select(F.col("value").cast("string").alias("value")).write.mode("append").text(path)


def publish_bar_stream(bars: DataFrame, checkpoint: str, path: str | None = None, *,
                       kafka_servers: str | None = None, topic: str = "ohlcv"):
    """Streaming publish with its own checkpoint; returns the query."""
    wire = encode_bars(bars)
    if kafka_servers:
        w = (wire.writeStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
             .option("topic", topic))
    else:
        if path is None:
            raise ValueError("path or kafka_servers is required")
        w = (wire.select(F.col("value").cast("string").alias("value")).writeStream.format("text")
             .option("path", path))
    return w.option("checkpointLocation", checkpoint).start()
