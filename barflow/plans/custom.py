"""Y5 in batch: back-test any per-bar strategy (``init_state`` / ``next`` / ``block``).

A strategy that declares its ``lookback`` is run like the built-in operators: its indicators and signals per
(key, chunk) with as many earlier bars copied in, started anew in each chunk, so a key is
spread over many tasks; only the signals go through the ledger, and the equity curve is
carried from chunk to chunk.

A strategy without (``lookback`` None: its start never stops to show) is a sequential state machine: bars are
hash-partitioned by key, sorted by the bar index and streamed through ``mapInPandas`` batch by batch with only
the strategy state and the ledger in memory (the sort spills; nothing gathers a key in one frame), and a
key's bars of a batch go through the strategy as one block. Keys run in parallel; one key's bars run in one task, in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barflow.operators.ledger import lockstep
from barflow.operators.sequence import CHUNK, DEFAULT_CHUNK_ROWS, HOME, _keys, over_chunks
from barflow.plans.strategies import StrategyRun, series
from barflow.streaming.protocol import BarStrategy, run_block


def _with_columns(pdf: pd.DataFrame, columns: dict, sig: np.ndarray) -> pd.DataFrame:
    return pdf.assign(**columns, sig=sig.astype(np.int32))


def _run_batches(batches, keys, strategy, cash0, halt):
    current, ind = None, None
    cash, pos = np.array([cash0]), np.array([0.0])
    for pdf in batches:
        if pdf.empty:
            continue
        code = pdf.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, code[1:] != code[:-1])), len(pdf))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = pdf.iloc[lo:hi]
            key = tuple(None if pd.isna(v) else v for v in part[keys].iloc[0])
            if key != current:
                current, ind = key, strategy.init_state()
                cash[0], pos[0] = cash0, 0.0
            closes = part["close"].to_numpy(dtype=np.float64)
            ind, columns, sig = run_block(strategy, ind, closes)
            trades = np.flatnonzero(sig)
            before = cash[0], pos[0]
            after = lockstep(cash, pos, np.zeros(len(trades), dtype=np.int64), sig[trades], closes[trades], halt)
            since = np.searchsorted(trades, np.arange(len(closes)), side="right")
            c, p = np.append(before[0], after[0])[since], np.append(before[1], after[1])[since]
            yield _with_columns(part, columns, sig).assign(cash=c, pos=p.astype(np.int64), equity=c + p * closes)


def strategy_frame(bars: DataFrame, strategy: BarStrategy, keys: Sequence[str] | str = ("symbol",),
                   chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Bars with the columns and signals of a strategy with a lookback, per (key, chunk)."""
    ks = _keys(keys)
    rows = series(bars, ks).select(*ks, "seq", "ts", "close")
    chunked = over_chunks(rows, strategy.lookback, chunk_rows)
    fields = [*rows.schema.fields, *(T.StructField(c, T.DoubleType()) for c in strategy.columns), T.StructField("sig", T.IntegerType())]
    names = [f.name for f in fields]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq", kind="stable")
        _, columns, sig = run_block(strategy, strategy.init_state(), pdf["close"].to_numpy(dtype=np.float64))
        return _with_columns(pdf, columns, sig)[pdf[HOME].to_numpy(dtype=bool)][names]

    return chunked.groupBy(*ks, CHUNK).applyInPandas(run, T.StructType(fields))


def run_bar_strategy(bars: DataFrame, strategy: BarStrategy, starting_cash: float, insolvency: str = "reference",
                     keys: Sequence[str] | str = ("symbol",), chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Per bar: keys, seq, ts, close, the strategy's columns, sig, cash, pos, equity."""
    ks = _keys(keys)
    if getattr(strategy, "lookback", None) is not None:
        run = StrategyRun(strategy.name, strategy_frame(bars, strategy, ks, chunk_rows), float(starting_cash), ks, insolvency, chunk_rows,
                          tuple(strategy.columns))
        return run.equity.select(*ks, "seq", "ts", "close", *strategy.columns, "sig", "cash", "pos", "equity")
    rows = series(bars, ks).select(*ks, "seq", "ts", "close")
    rows = rows.repartition(*ks).sortWithinPartitions(*ks, "seq")
    fields = list(rows.schema.fields)
    fields += [T.StructField(c, T.DoubleType()) for c in strategy.columns]
    fields += [T.StructField("sig", T.IntegerType()), T.StructField("cash", T.DoubleType()),
               T.StructField("pos", T.LongType()), T.StructField("equity", T.DoubleType())]
    fn = partial(_run_batches, keys=ks, strategy=strategy, cash0=float(starting_cash), halt=(insolvency == "halt"))
    return rows.mapInPandas(fn, T.StructType(fields))
