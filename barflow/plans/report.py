"""V1 / V2: the data behind the chart and the "Ending cash" line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.functions.columns import money_text
from barflow.plans.strategies import StrategyRun


def chart_frame(bt: StrategyRun) -> DataFrame:
    """V1: per bar OHLC, the strategy's overlay series, signal and equity."""
    return bt.equity.select(*bt.keys, "ts", "open", "high", "low", "close", *bt.overlays,
                            "sig", "cash", "pos", "equity")


def summary(bt: StrategyRun) -> DataFrame:
    """V2: per key trade counts, final value and its text."""
    return bt.final.select(*bt.keys, F.lit(bt.name).alias("strategy"), "n_signals", "n_opened",
                           "final_value", money_text("final_value").alias("text"))
