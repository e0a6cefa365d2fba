"""Y2: many (fast, slow) parameter pairs in one plan.

Each *distinct* period gets one indicator column, computed once: for the SMA
one running sum and a difference of two of its values each (one sort per chunk), for the
EMA all in one recurrence pass. Each parameter set is one signal expression; only
the bars with a signal become rows (one for each set that has one there), and every
(symbol, set) runs its own ledger, in parallel. Bars are never multiplied by sets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators import indicators as ind
from barflow.operators.sequence import DEFAULT_CHUNK_ROWS, _keys, with_seq
from barflow.functions.columns import cross_signal, threshold_signal
from barflow.plans.strategies import StrategyRun
from barflow.schema import DEFAULT_CASH, RSI_HIGH, RSI_LOW
from barflow.session import materialize


def _numbered(bars: DataFrame, ks: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Bars with their index, and what tells each series' last close: the stored bars, which are not numbered for it again."""
    if "seq" in bars.columns:
        return bars, bars.select(*ks, "seq", "close")
    stored = materialize(bars, "bars")
    rest = [f.name for f in stored.schema.fields if f.name not in (*ks, "ts") and not isinstance(f.dataType, (T.MapType, T.ArrayType))]
    return with_seq(stored, ks), stored.select(*ks, "ts", *rest)


def sweep_sma(bars: DataFrame, pairs: Sequence[tuple[int, int]], starting_cash: float = DEFAULT_CASH,
              insolvency: str = "reference", keys: Sequence[str] | str = ("symbol",),
              chunk_rows: int = DEFAULT_CHUNK_ROWS) -> StrategyRun:
    """Y2 for the SMA crossover."""
    ks = _keys(keys)
    if not pairs:
        raise ValueError("at least one (fast, slow) pair is required")
    periods = sorted({int(p) for pair in pairs for p in pair})
    bars, last = _numbered(bars, ks)
    f = ind.rolling_means(bars, {f"sma_{p}": p for p in periods}, keys=ks,
                          chunk_rows=chunk_rows)
    return _explode_pairs(last, f, pairs, "sma", ks, starting_cash, insolvency, chunk_rows)


def sweep_ema(bars: DataFrame, pairs: Sequence[tuple[int, int]], starting_cash: float = DEFAULT_CASH,
              insolvency: str = "reference", keys: Sequence[str] | str = ("symbol",),
              chunk_rows: int = DEFAULT_CHUNK_ROWS) -> StrategyRun:
    """Y2 for the EMA crossover: every distinct span in one recurrence pass."""
    ks = _keys(keys)
    if not pairs:
        raise ValueError("at least one (fast, slow) pair is required")
    spans = sorted({int(p) for pair in pairs for p in pair})
    bars, last = _numbered(bars, ks)
    f = ind.ema(bars, {f"ema_{p}": p for p in spans}, keys=ks, chunk_rows=chunk_rows)
    return _explode_pairs(last, f, pairs, "ema", ks, starting_cash, insolvency, chunk_rows)


def _pair_params(pairs) -> list[dict[str, int]]:
    return [{"param_id": i, "fast_period": int(s), "slow_period": int(l_)} for i, (s, l_) in enumerate(pairs)]


def _explode_pairs(bars: DataFrame, f: DataFrame, pairs, prefix: str, ks, starting_cash, insolvency, chunk_rows) -> StrategyRun:
    values = [{"fast": F.col(f"{prefix}_{s}"), "slow": F.col(f"{prefix}_{l_}")} for s, l_ in pairs]
    sigs = [cross_signal(f"prev_{prefix}_{s}", f"prev_{prefix}_{l_}", f"{prefix}_{s}", f"{prefix}_{l_}") for s, l_ in pairs]
    base = [c for c in f.columns if not c.startswith(f"{prefix}_") and not c.startswith(f"prev_{prefix}_")]
    return _sweep_run(prefix, bars, f, base, _pair_params(pairs), values, sigs, ks, starting_cash, insolvency, chunk_rows)


def _sweep_run(name, bars, f, base, params, values, sigs, ks, starting_cash, insolvency, chunk_rows) -> StrategyRun:
    """A run over a grid: ``frame`` has a row per bar and parameter set (a plan, for equity curves);
    what is stored are the signal rows alone, exploded after the zeros are dropped."""
    rows = [F.struct(*[F.lit(v).alias(k) for k, v in p.items()], *[c.alias(k) for k, c in v.items()], s.alias("sig"))
            for p, v, s in zip(params, values, sigs, strict=True)]
    frame = f.select(*base, F.explode(F.array(*rows)).alias("_p")).select(*base, "_p.*")
    marks = [F.struct(*[F.lit(v).alias(k) for k, v in p.items()], s.alias("sig")) for p, s in zip(params, sigs, strict=True)]
    hits = F.filter(F.array(*marks), lambda x: x["sig"] != 0)
    signals = f.select(*ks, "seq", "ts", "close", F.explode(hits).alias("_p")).select(*ks, "seq", "ts", "close", "_p.*")
    return StrategyRun(name, frame, float(starting_cash), [*ks, *params[0]], insolvency, chunk_rows, tuple(values[0]),
                       signals=signals, series_bars=bars, grid=params)


def sweep_rsi(bars: DataFrame, periods: Sequence[int], starting_cash: float = DEFAULT_CASH,
              insolvency: str = "reference", keys: Sequence[str] | str = ("symbol",),
              chunk_rows: int = DEFAULT_CHUNK_ROWS) -> StrategyRun:
    """Y2 for the RSI strategy: every period's RSI in one window and one
    recurrence pass, then one ledger per (symbol, period)."""
    ks = _keys(keys)
    if not periods:
        raise ValueError("at least one period is required")
    bars, last = _numbered(bars, ks)
    f = ind.rsi_many(bars, periods, keys=ks, chunk_rows=chunk_rows)
    params = [{"param_id": i, "rsi_period": int(n)} for i, n in enumerate(periods)]
    values = [{"rsi": F.col(f"rsi_{n}")} for n in periods]
    sigs = [threshold_signal(f"prev_rsi_{n}", f"rsi_{n}", RSI_LOW, RSI_HIGH) for n in periods]
    base = [c for c in f.columns if not c.startswith(("rsi_", "prev_rsi_"))]
    return _sweep_run("rsi", last, f, base, params, values, sigs, ks, starting_cash, insolvency, chunk_rows)


def sweep_all(bars: DataFrame, sma_pairs: Sequence[tuple[int, int]] = (), ema_pairs: Sequence[tuple[int, int]] = (),
              rsi_periods: Sequence[int] = (), starting_cash: float = DEFAULT_CASH, insolvency: str = "reference",
              keys: Sequence[str] | str = ("symbol",), chunk_rows: int = DEFAULT_CHUNK_ROWS) -> StrategyRun:
    """Y2 across strategies: the SMA, EMA and RSI grids in one frame and one
    ledger job keyed by (symbol, strategy, param_id). Each strategy's row
    carries ``param_a``/``param_b``: fast/slow periods, or the RSI period and 0
    (key columns are join keys downstream and must not be NULL)."""
    ks = _keys(keys)
    bars, last = _numbered(bars, ks)
    runs = []
    for name, grid, make in (("sma", sma_pairs, sweep_sma), ("ema", ema_pairs, sweep_ema), ("rsi", rsi_periods, sweep_rsi)):
        if grid:
            runs.append((name, make(bars, grid, starting_cash, insolvency, ks, chunk_rows)))
    if not runs:
        raise ValueError("at least one grid is required")

    def named(df: DataFrame, name: str, run: StrategyRun) -> DataFrame:
        a, b = (F.col("rsi_period"), F.lit(0)) if name == "rsi" else (F.col("fast_period"), F.col("slow_period"))
        return df.select(*ks, "seq", "ts", "close", "sig", F.lit(name).alias("strategy"), "param_id",
                         a.alias("param_a"), b.alias("param_b"))

    frame = reduce(DataFrame.unionByName, [named(r.frame, n, r) for n, r in runs])
    signals = reduce(DataFrame.unionByName, [named(r.signals, n, r) for n, r in runs])
    params = [{"strategy": n, "param_id": p["param_id"], "param_a": p.get("rsi_period", p.get("fast_period")),
               "param_b": p.get("slow_period", 0)} for n, r in runs for p in r.grid]
    return StrategyRun("all", frame, float(starting_cash), [*ks, "strategy", "param_id", "param_a", "param_b"],
                       insolvency, chunk_rows, (), signals=signals, series_bars=last, grid=params)
