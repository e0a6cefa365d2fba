"""Stored bars: a parquet table partitioned by symbol and year.

Bars are the small, reusable result of the one heavy step (ticks -> bars).
Writing them partitioned lets later scans prune by symbol and year and push the
ts range into the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.schema import BAR_SCHEMA


def write_bar_table(bars: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write bars under ``symbol=/year=`` folders.

    The rows are rebalanced by (symbol, year) first: a partition is written by few
    tasks, and one with very many rows is split over several. With
    ``mode="overwrite"`` only the (symbol, year) partitions present in ``bars``
    are replaced (dynamic partition overwrite)."""
    (bars.withColumn("year", F.year("ts")).hint("rebalance", "symbol", "year")
     .write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("symbol", "year").parquet(path))


def read_bar_table(spark: SparkSession, path: str, symbols: Sequence[str] | None = None,
                   start: str | None = None, end: str | None = None,
                   extra: Sequence[T.StructField] = (T.StructField("n_ticks", T.LongType()),)) -> DataFrame:
    """Bars of ``symbols`` with ts in [start, end] (dates, inclusive).

    Partition types are given explicitly (a symbol such as "123" must stay a
    string), so symbol and year filters prune folders and the ts range is
    pushed into the parquet scan."""
    data = [f for f in BAR_SCHEMA.fields if f.name != "symbol"] + list(extra)
    schema = T.StructType(data + [T.StructField("symbol", T.StringType()),
                                  T.StructField("year", T.IntegerType())])
    df = spark.read.schema(schema).parquet(path)
    if symbols is not None:
        df = df.filter(F.col("symbol").isin(list(symbols)))
    if start is not None:
        df = df.filter((F.col("year") >= int(start[:4])) & (F.col("ts") >= F.lit(start).cast("timestamp_ntz")))
    if end is not None:
        hi = F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
        df = df.filter((F.col("year") <= int(end[:4])) & (F.col("ts") < hi))
    return df.select("symbol", *[f.name for f in data])
