"""Replay bars, or any frame, to a stream in time order.

The rows are stored once, as parquet partitioned by slice (one job; the stored table
also cuts the lineage back to the ticks). Slices are contiguous time ranges, so
reading them in order replays the market in order; the pace is the caller's.

``slice_stream(k)`` reads slice k of the stored table as a stream: nothing is copied.
Run on one checkpoint for k = 0, 1, ... it goes on where the last one ended, also after a restart: the
file source remembers the files it has read, so a slice that is run again brings nothing twice.
``feed(k)`` appends slice k to a source folder instead, for a query that stays up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.session import materialize
from barflow.sources.codec import encode_bars

_MICROS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"


@dataclass
class Replay:
    spark: SparkSession
    staging: str
    source: str
    n_slices: int

    def slice_stream(self, k: int, session: SparkSession | None = None) -> DataFrame:
        """The messages (key, value) of slice k."""
        return (session or self.spark).readStream.schema("key binary, value binary").parquet(_slice_path(self.staging, k))

    def feed(self, k: int) -> None:
        part = self.spark.read.parquet(self.staging).filter(F.col("slice") == int(k))
        part.select(F.col("value").cast("string").alias("value")).write.mode("append").text(self.source)

    def feed_all(self, after_each=None) -> None:
        for k in range(self.n_slices):
            self.feed(k)
            if after_each is not None:
                after_each(k)


# Rows that a slice holds about when the number of slices is not given, and the least number of slices.
SLICE_ROWS = 1_000_000
LEAST_SLICES = 4


def _slice_path(folder: str, k: int) -> str:
    """A pattern that one slice matches. Given a pattern, the file source can read files of earlier slices again, as a restart on
    their checkpoint does; given the slice's own folder it expects every file below that."""
    return f"{folder}/slice={{{int(k)}}}"


def _slices(df: DataFrame, n_slices: int | None) -> tuple[object, int]:
    """Slice number of a row by equal spans of ``_us``, and how many there are (one aggregate row is read)."""
    lo, hi, n = df.agg(F.min("_us"), F.max("_us"), F.count(F.lit(1))).first()
    if n_slices is None:
        n_slices = max(LEAST_SLICES, -(-n // SLICE_ROWS))
    lo, hi = (0, 0) if lo is None else (int(lo), int(hi))
    span = max(1, (hi - lo) // n_slices + 1)
    return F.least(F.floor((F.col("_us") - F.lit(lo)) / F.lit(span)), F.lit(n_slices - 1)).cast("int"), n_slices


def _store(rows: DataFrame, path: str, n_slices: int) -> None:
    """Write the rows by slice; a slice without rows (a quiet span) gets an empty folder's file, so that it can be streamed."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").partitionBy("slice").parquet(path)
    held = {r["slice"] for r in spark.read.parquet(path).select("slice").distinct().collect()} if n_slices else set()  # one row a slice
    empty = spark.createDataFrame([], rows.drop("slice").schema)
    for k in sorted(set(range(n_slices)) - held):
        empty.write.mode("overwrite").parquet(f"{path}/slice={k}")


def stage_replay(bars: DataFrame, folder: str, n_slices: int | None = None) -> Replay:
    """Cut bars into ``n_slices`` equal time spans (by default as many as their number
    asks for) and stage their messages. The bars are materialized once."""
    if n_slices is not None and n_slices < 1:
        raise ValueError("n_slices must be >= 1")
    spark = bars.sparkSession
    b = materialize(bars.withColumn("_us", F.expr(_MICROS)), "replay-bars")
    number, n_slices = _slices(b, n_slices)
    staged = encode_bars(b.withColumn("slice", number), keep=("slice",))
    base = folder.rstrip("/")
    _store(staged, f"{base}/staging", n_slices)
    return Replay(spark, f"{base}/staging", f"{base}/source", n_slices)


@dataclass
class FrameReplay:
    """Replay of any frame (e.g. ticks) as parquet files, slice by slice."""

    spark: SparkSession
    staging: str
    source: str
    n_slices: int
    schema: object

    def slice_stream(self, k: int, session: SparkSession | None = None) -> DataFrame:
        """The rows of slice k."""
        return (session or self.spark).readStream.schema(self.schema).parquet(_slice_path(self.staging, k))

    def feed(self, k: int) -> None:
        part = self.spark.read.parquet(self.staging).filter(F.col("slice") == int(k)).drop("slice")
        part.write.mode("append").parquet(self.source)

    def stream(self, session: SparkSession | None = None) -> DataFrame:
        return (session or self.spark).readStream.schema(self.schema).parquet(self.source)

    def feed_all(self, after_each=None) -> None:
        for k in range(self.n_slices):
            self.feed(k)
            if after_each is not None:
                after_each(k)


def stage_frame_replay(df: DataFrame, folder: str, n_slices: int | None = None, ts: str = "ts") -> FrameReplay:
    """Like ``stage_replay`` but keeps the rows as they are (parquet). The bounds come from a
    plain aggregate, so the rows are written once to the staging folder and once a slice."""
    if n_slices is not None and n_slices < 1:
        raise ValueError("n_slices must be >= 1")
    spark = df.sparkSession
    b = df.withColumn("_us", F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)"))
    number, n_slices = _slices(b, n_slices)
    base = folder.rstrip("/")
    _store(b.withColumn("slice", number).drop("_us"), f"{base}/staging", n_slices)
    return FrameReplay(spark, f"{base}/staging", f"{base}/source", n_slices, df.schema)
