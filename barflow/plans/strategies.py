"""Strategies as lazy DataFrame plans.

bars -> seq -> indicators (+prev) -> signal -> ledger fold -> final / equity.
Every function takes bars with ``symbol, ts, open, high, low, close`` (extra
columns ride along) and returns a ``StrategyRun`` of lazy DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.operators import indicators as ind
from barflow.operators.ledger import equity_curve, final_values, run_ledger, sweep_final_values
from barflow.operators.sequence import DEFAULT_CHUNK_ROWS, _keys, join_on, with_seq
from barflow.operators.signals import with_cross_signal, with_threshold_signal
from barflow.schema import DEFAULT_CASH, DEFAULT_LONG, DEFAULT_RSI_PERIOD, DEFAULT_SHORT
from barflow.session import materialize
from barflow.sources.bar_index import Reader, lookback_start


@dataclass
class StrategyRun:
    """A strategy run. ``frame`` is the per-bar plan (bar columns, seq,
    indicators, sig); ``keys`` identify one series (a NULL key value is a series of
    its own: key joins are null-safe). The ledger, final values and equity read a stored copy
    of it, made on first use, and ``trades`` is stored on first use too: they
    feed several branches, which would otherwise each re-run the plan."""

    name: str
    frame: DataFrame
    starting_cash: float
    keys: list[str]
    insolvency: str = "reference"
    chunk_rows: int = DEFAULT_CHUNK_ROWS
    overlays: tuple[str, ...] = ()
    # Of a sweep: the signal rows, the series' bars (keys, seq, close) and the parameter sets.
    signals: DataFrame | None = None
    series_bars: DataFrame | None = None
    grid: list[dict] | None = None
    _stored_signals: DataFrame | None = field(default=None, repr=False)
    _stored: DataFrame | None = field(default=None, repr=False)
    _trades: DataFrame | None = field(default=None, repr=False)

    @property
    def stored_frame(self) -> DataFrame:
        if self._stored is None:
            self._stored = materialize(self.frame, f"{self.name}-frame")
        return self._stored

    @property
    def stored_signals(self) -> DataFrame:
        if self._stored_signals is None:
            self._stored_signals = materialize(self.signals, f"{self.name}-signals")
        return self._stored_signals

    @property
    def trades(self) -> DataFrame:
        if self._trades is None:
            source = self.stored_frame if self.signals is None else self.stored_signals
            self._trades = materialize(
                run_ledger(source, self.starting_cash, self.keys, insolvency=self.insolvency),
                f"{self.name}-trades")
        return self._trades

    @property
    def final(self) -> DataFrame:
        if self.signals is not None:
            return sweep_final_values(self.series_bars, self.stored_signals, self.trades, self.grid, self.starting_cash, self.keys)
        return final_values(self.stored_frame, self.trades, self.starting_cash, self.keys)

    @property
    def equity(self) -> DataFrame:
        return equity_curve(self.frame if self.signals is not None else self.stored_frame, self.trades, self.starting_cash, self.keys,
                            chunk_rows=self.chunk_rows)


def series(bars: DataFrame, keys: Sequence[str] | str = ("symbol",)) -> DataFrame:
    """Bars with their per-key index ``seq``. The bars are materialized first:
    the index reads them twice (segment counts and rows)."""
    ks = _keys(keys)
    return bars if "seq" in bars.columns else with_seq(materialize(bars, "bars"), ks)


def _prepare(bars: DataFrame, keys) -> DataFrame:
    return series(bars, keys)


def sma_crossover(bars: DataFrame, starting_cash: float = DEFAULT_CASH, short_period: int = DEFAULT_SHORT,
                  long_period: int = DEFAULT_LONG, insolvency: str = "reference",
                  keys: Sequence[str] | str = ("symbol",), chunk_rows: int = DEFAULT_CHUNK_ROWS) -> StrategyRun:
    """Simple moving-average crossover."""
    ks = _keys(keys)
    f = ind.rolling_means(_prepare(bars, ks), {"fast": short_period, "slow": long_period},
                          keys=ks, chunk_rows=chunk_rows)
    f = with_cross_signal(f, "fast", "slow")
    return StrategyRun("sma", f, float(starting_cash), ks, insolvency, chunk_rows, ("fast", "slow"))


def ema_crossover(bars: DataFrame, starting_cash: float = DEFAULT_CASH, short_period: int = DEFAULT_SHORT,
                  long_period: int = DEFAULT_LONG, insolvency: str = "reference",
                  keys: Sequence[str] | str = ("symbol",), chunk_rows: int = DEFAULT_CHUNK_ROWS) -> StrategyRun:
    """Exponential moving-average crossover."""
    ks = _keys(keys)
    f = ind.ema(_prepare(bars, ks), {"fast": short_period, "slow": long_period},
                keys=ks, chunk_rows=chunk_rows)
    f = with_cross_signal(f, "fast", "slow")
    return StrategyRun("ema", f, float(starting_cash), ks, insolvency, chunk_rows, ("fast", "slow"))


def rsi_strategy(bars: DataFrame, starting_cash: float = DEFAULT_CASH, rsi_period: int = DEFAULT_RSI_PERIOD,
                 insolvency: str = "reference", keys: Sequence[str] | str = ("symbol",),
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> StrategyRun:
    """Buy on leaving the oversold zone upward, sell on leaving overbought downward."""
    ks = _keys(keys)
    f = ind.rsi(_prepare(bars, ks), rsi_period, keys=ks, chunk_rows=chunk_rows)
    f = with_threshold_signal(f, "rsi")
    return StrategyRun("rsi", f, float(starting_cash), ks, insolvency, chunk_rows, ("rsi",))


STRATEGIES = {"sma": sma_crossover, "ema": ema_crossover, "rsi": rsi_strategy}


def run_strategy(name: str, bars: DataFrame, **params) -> StrategyRun:
    """Dispatch by name; periods must be integers >= 1."""
    if name not in STRATEGIES:
        raise ValueError(f"unknown strategy {name!r}; expected one of {sorted(STRATEGIES)}")
    for p in ("short_period", "long_period", "rsi_period"):
        if p in params and (params[p] is None or int(params[p]) != params[p] or params[p] < 1):
            raise ValueError(f"{p} must be an integer >= 1")
    return STRATEGIES[name](bars, **params)


def with_warmup(bars: DataFrame, start: str, end: str | None, n: int,
                keys: Sequence[str] | str = ("symbol",)) -> DataFrame:
    """Bars in [start, end] plus up to ``n`` bars before ``start`` per key.

    Uses the bar index: the first in-range index per key (a one-row-per-key
    aggregate) minus n, so no key is sorted as a whole. ``seq`` restarts at 0
    on the first kept bar; adds ``in_range``.
    """
    ks = _keys(keys)
    if end is not None:  # before anything is stored: later bars change no index
        bars = bars.filter(F.col("ts") <= F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
                           - F.expr("INTERVAL 1 MICROSECOND"))
    b = _prepare(bars, ks)
    in_range = F.col("ts") >= F.lit(start).cast("timestamp_ntz")
    first = b.filter(in_range).groupBy(*ks).agg(F.min("seq").alias("_first"))
    lo = F.greatest(F.col("_first") - F.lit(int(n)), F.lit(0).cast("long"))
    # Re-index from the first kept bar so the window is a series of its own.
    return (join_on(b, first, ks)
            .filter(F.col("seq") >= lo)
            .withColumn("seq", F.col("seq") - lo)
            .withColumn("in_range", in_range)
            .drop("_first"))


def trim_warmup(frame: DataFrame) -> DataFrame:
    """Drop warm-up rows and their signals after indicators are computed."""
    return frame.filter(F.col("in_range"))


def _lookback(strategy: str, params: dict) -> int:
    """Bars before a range that its first indicators need; fills in the default periods."""
    if strategy in ("sma", "ema"):
        params.setdefault("short_period", DEFAULT_SHORT)
        params.setdefault("long_period", DEFAULT_LONG)
        return max(params["short_period"], params["long_period"])
    params.setdefault("rsi_period", DEFAULT_RSI_PERIOD)
    return params["rsi_period"] + 1


def read_warmup(read: Reader, index: DataFrame, start: str, end: str | None, n: int, symbols: Sequence[str] | None = None) -> DataFrame:
    """Y1 on stored bars: ``with_warmup`` of what ``read`` gives for the range that the index allows,
    so partitions and times outside are not read."""
    return with_warmup(read(symbols, lookback_start(index, start, n, symbols), end), start, end, n)


def run_stored_range(read: Reader, index: DataFrame, symbol: str | None, start: str, end: str, strategy: str = "sma",
                     warmup: bool = True, **params) -> StrategyRun:
    """``run_range`` on stored bars (or ticks) with a bar index: symbol and both dates reach the scan, and
    nothing but the range with its look-back is aggregated or stored."""
    n = _lookback(strategy, params) if warmup else 0
    symbols = None if symbol is None else [symbol]
    return run_range(read(symbols, lookback_start(index, start, n, symbols), end), symbol, start, end, strategy, warmup=warmup, **params)


def run_range(bars: DataFrame, symbol: str | None, start: str, end: str, strategy: str = "sma",
                   starting_cash: float = DEFAULT_CASH, warmup: bool = True, insolvency: str = "reference",
                   **params) -> StrategyRun:
    """One run of the form "ticker, dates, cash, strategy, periods".

    Bars of ``symbol`` (all symbols when None) in [start, end]; with ``warmup``
    the indicators first see the bars just before ``start`` (as many as the
    longest lookback), and only in-range bars can trade. Periods default to the
    strategy's defaults.
    """
    lookback = _lookback(strategy, params)
    b = bars if symbol is None else bars.filter(F.col("symbol") == symbol)
    win = with_warmup(b, start, end, lookback if warmup else 0)
    bt = run_strategy(strategy, win, starting_cash=starting_cash, insolvency=insolvency, **params)
    return StrategyRun(bt.name, trim_warmup(bt.frame), bt.starting_cash, bt.keys, bt.insolvency,
                    bt.chunk_rows, bt.overlays)
