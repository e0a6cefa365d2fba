"""Trading signals from indicator columns (pure column expressions)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barflow.functions.columns import cross_signal, threshold_signal
from barflow.schema import RSI_HIGH, RSI_LOW


def with_cross_signal(df: DataFrame, fast: str, slow: str, out: str = "sig") -> DataFrame:
    """G1 on columns ``fast``, ``slow``, ``prev_fast``, ``prev_slow``."""
    return df.withColumn(out, cross_signal(f"prev_{fast}", f"prev_{slow}", fast, slow))


def with_threshold_signal(df: DataFrame, col: str = "rsi", low: float = RSI_LOW,
                          high: float = RSI_HIGH, out: str = "sig") -> DataFrame:
    """G2 on ``col`` and ``prev_<col>``."""
    return df.withColumn(out, threshold_signal(f"prev_{col}", col, low, high))
