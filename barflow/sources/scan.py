"""Bars of one symbol in an inclusive date range, ascending, capped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.operators.bars import divides_day, ohlcv_bars


def scan_bars(bars: DataFrame, symbol: str, start: str, end: str, limit: int | None = None) -> DataFrame:
    """Filter (pushed to the scan when ``bars`` is a table), order by ts. ``limit``
    caps the rows as the upstream request does (``schema.SCAN_LIMIT``); by default all come."""
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    found = bars.filter((F.col("symbol") == symbol) & (F.col("ts") >= lo) & (F.col("ts") < hi)).orderBy("ts")
    return found if limit is None else found.limit(int(limit))


def ticks_between(ticks: DataFrame, symbols: Sequence[str] | None, start: str | None, end: str | None, every: str = "1 day") -> DataFrame:
    """Bars of ``symbols`` (None: all) whose start lies in [start, end] (None: open), from the ticks of that range
    alone: both reach the parquet scan (see ``scan_bars_from_ticks``)."""
    one, tiles = F.expr("INTERVAL 1 DAY"), divides_day(every)
    lo = None if start is None else F.lit(start).cast("timestamp_ntz")
    hi = None if end is None else F.lit(end).cast("timestamp_ntz") + one
    if symbols is not None:
        ticks = ticks.filter(F.col("symbol").isin(list(symbols)))
    step = F.expr(f"INTERVAL {every}")
    if lo is not None:
        ticks = ticks.filter(F.col("ts") >= (lo if tiles else lo - step))
    if hi is not None:
        ticks = ticks.filter(F.col("ts") < (hi if tiles else hi + step))
    bars = ohlcv_bars(ticks, every)
    if lo is not None and not tiles:
        bars = bars.filter(F.col("ts") >= lo)
    return bars if hi is None or tiles else bars.filter(F.col("ts") < hi)


def scan_bars_from_ticks(ticks: DataFrame, symbol: str, start: str, end: str, every: str = "1 day",
                         limit: int | None = None) -> DataFrame:
    """S5 straight from ticks: bars of ``symbol`` whose start lies in [start, end].

    The ticks are filtered first, so symbol and range reach the parquet scan. When
    the bucket width divides a day, a bar starting in the range holds exactly the
    ticks of [start, end + 1 day); otherwise the ticks of one bucket more on either
    side are read and the bars are filtered after.
    """
    t = ticks.filter(F.col("symbol") == symbol)
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    if not divides_day(every):
        lo, hi = lo - F.expr(f"INTERVAL {every}"), hi + F.expr(f"INTERVAL {every}")
    t = t.filter((F.col("ts") >= lo) & (F.col("ts") < hi))
    return scan_bars(ohlcv_bars(t, every), symbol, start, end, limit)
