"""A sparse index of stored bars: how many a symbol has in each month.

A look-back of n bars before a date is a number of rows, which no scan can be told. With the index it is a date first: the
start of the latest month from which on at least n bars lie before the date's month. So a run over a ticker and two dates reads its
partitions and its time range only, however long the history; the few bars too many are cut by the exact rule after.

The index has one row for each (symbol, month), stands beside the bar table and is kept up to date by months
(``write_bar_index`` replaces the months it is given). What comes to the driver is one date a symbol asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

def bar_counts(bars: DataFrame) -> DataFrame:
    """(symbol, year, month, n) of bars: ``month`` is the month's first instant."""
    month = F.date_trunc("month", "ts").cast("timestamp_ntz")
    return bars.groupBy("symbol", month.alias("month")).agg(F.count(F.lit(1)).alias("n")).select("symbol", F.year("month").alias("year"), "month", "n")


def tick_bar_counts(ticks: DataFrame, every: str = "1 day") -> DataFrame:
    """The same of the bars that ticks make, from symbols and times alone: no price is aggregated and no bar stored."""
    starts = ticks.groupBy("symbol", F.window("ts", every).start.alias("ts")).agg(F.lit(1))
    return bar_counts(starts)


def write_bar_index(counts: DataFrame, path: str) -> None:
    """Store the index by year; only the years present in ``counts`` are replaced."""
    (counts.hint("rebalance", "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year").parquet(path))


def read_bar_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("symbol string, month timestamp_ntz, n long, year int").parquet(path)


def lookback_start(index: DataFrame, start: str, n: int, symbols: Sequence[str] | None = None) -> str:
    """A date such that every symbol (of ``symbols``) has n of its bars before ``start`` from it on, or all it
    has. ``start`` itself if n is 0; else the first of a month, at the latest of the month of ``start``."""
    if n <= 0:
        return start
    first = F.date_trunc("month", F.lit(start).cast("timestamp_ntz")).cast("timestamp_ntz")
    before = index.where((F.col("month") < first) & (F.col("year") <= int(start[:4])))
    if symbols is not None:
        before = before.where(F.col("symbol").isin(list(symbols)))
    # Bars from a month on, and from the next month on; the table has a row a month.
    back = Window.partitionBy("symbol").orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, 0)
    counted = before.select("symbol", "month", F.sum("n").over(back).alias("total"), "n")
    # The last month that is needed of each symbol: the one that reaches n, or its first.
    needed = counted.where(F.col("total") - F.col("n") < int(n)).agg(F.min("month")).first()[0]
    return f"{start[:7]}-01" if needed is None else needed.strftime("%Y-%m-%d")


# Reads bars of symbols (None: all) with ts in [start, end], both dates inclusive; start None: from the first.
Reader = Callable[[Sequence[str] | None, str | None, str | None], DataFrame]
