"""A strategy evaluated incrementally per symbol on a bar stream.

``groupBy(symbol).transformWithStateInPandas``: each micro-batch hands a symbol's new bars to a
stateful processor, Arrow batch by Arrow batch. Of those it keeps two numbers a bar, brings them in
order and applies the Y5 strategy and the ledger to blocks of ``BLOCK_ROWS`` bars, as arrays; each block
is passed on before the next. What it keeps between micro-batches is a value (last ts, cash, position and
the strategy's numbers) and a list (the closes of its window) in the state store, so state and work per
bar are bounded by the lookback, not by the length of the history; nothing is recomputed from history.
Bars at or before the last seen ts are emitted with ``late = true`` and leave the state untouched.

The run must use the RocksDB state store (``streaming.control.Run`` sees to it).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from barflow.operators.ledger import lockstep
from barflow.streaming.protocol import BarStrategy, run_block

BLOCK_ROWS = 10_000
VALUE_SCHEMA = T.StructType([
    T.StructField("last_ts", T.LongType()),      # microseconds since epoch (wall clock)
    T.StructField("cash", T.DoubleType()),
    T.StructField("pos", T.LongType()),
    T.StructField("ind", T.ArrayType(T.DoubleType())),
])
RING_SCHEMA = T.StructType([T.StructField("close", T.DoubleType())])


def output_schema(strategy: BarStrategy) -> T.StructType:
    fields = [T.StructField("symbol", T.StringType()), T.StructField("ts", T.TimestampNTZType()),
              T.StructField("close", T.DoubleType())]
    fields += [T.StructField(c, T.DoubleType()) for c in strategy.columns]
    fields += [T.StructField("sig", T.IntegerType()), T.StructField("cash", T.DoubleType()),
               T.StructField("pos", T.LongType()), T.StructField("equity", T.DoubleType()),
               T.StructField("late", T.BooleanType())]
    return T.StructType(fields)


def _micros(ts: pd.Series) -> np.ndarray:
    return ts.astype("datetime64[us]").astype("int64").to_numpy()


class StrategyProcessor(StatefulProcessor):
    """One symbol's strategy and account."""

    def __init__(self, strategy: BarStrategy, starting_cash: float, halt: bool, warmup_col: str | None):
        self.strategy, self.cash0, self.halt, self.warmup_col = strategy, starting_cash, halt, warmup_col
        self.fixed = getattr(strategy, "fixed", len(strategy.init_state()))
        self.names = [f.name for f in output_schema(strategy).fields]

    def init(self, handle) -> None:
        self.value = handle.getValueState("account", VALUE_SCHEMA)
        self.ring = handle.getListState("window", RING_SCHEMA)

    def close(self) -> None:
        pass

    def _load(self):
        if not self.value.exists():
            return None, self.cash0, 0, list(self.strategy.init_state())
        last_ts, cash, pos, ind = self.value.get()
        return last_ts, cash, pos, [*ind, *((x[0] for x in self.ring.get()) if self.ring.exists() else ())]

    def _store(self, last_ts: int, cash: float, pos: int, ind: list[float]) -> None:
        self.value.update((int(last_ts), float(cash), int(pos), [float(x) for x in ind[:self.fixed]]))
        if len(ind) > self.fixed:
            self.ring.put([(float(x),) for x in ind[self.fixed:]])
        else:
            self.ring.clear()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Bars before the stream's first (arrays ``tss`` and ``closes``) advance the indicators and never trade."""
        last_ts, cash, pos, ind = self._load()
        for tss, closes in zip(initialState["tss"], initialState["closes"], strict=True):
            if len(tss):
                ind, _, _ = run_block(self.strategy, ind, np.asarray(closes, dtype=np.float64))
                last_ts = int(tss[-1])
        if last_ts is not None:
            self._store(last_ts, cash, pos, ind)

    def handleInputRows(self, key, rows, timerValues):
        parts = [(_micros(pdf["ts"]), pdf["close"].to_numpy(dtype=np.float64),
                  pdf[self.warmup_col].fillna(False).to_numpy(dtype=bool) if self.warmup_col else np.zeros(len(pdf), dtype=bool)) for pdf in rows]
        micros, closes, warm = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(micros, kind="stable")
        micros, closes, warm = micros[order], closes[order], warm[order]
        last_ts, cash, pos, ind = self._load()
        late = np.append(False, micros[1:] == micros[:-1])
        if last_ts is not None:
            late |= micros <= last_ts
        for first in range(0, len(micros), BLOCK_ROWS):
            at = slice(first, first + BLOCK_ROWS)
            fresh = np.flatnonzero(~late[at])
            out = {"symbol": key[0], "ts": pd.Series(micros[at].view("datetime64[us]")), "close": closes[at],
                   **{c: np.full(len(micros[at]), np.nan) for c in self.strategy.columns}, "sig": np.zeros(len(micros[at]), dtype=np.int32)}
            account = np.full((2, len(micros[at])), np.nan)
            if len(fresh):
                x = closes[at][fresh]
                ind, columns, sig = run_block(self.strategy, ind, x)
                for c in self.strategy.columns:
                    out[c][fresh] = columns[c]
                sig = np.where(warm[at][fresh], 0, sig)
                out["sig"][fresh] = sig
                trades = np.flatnonzero(sig)
                held = np.array([cash]), np.array([float(pos)])
                after = lockstep(*held, np.zeros(len(trades), dtype=np.int64), sig[trades], x[trades], self.halt)
                # The state after the latest signal at or before each bar.
                since = np.searchsorted(trades, np.arange(len(x)), side="right")
                account[:, fresh] = np.append(cash, after[0])[since], np.append(pos, after[1])[since]
                cash, pos, last_ts = float(held[0][0]), int(held[1][0]), int(micros[at][fresh[-1]])
            out |= {"cash": account[0], "pos": pd.Series(account[1]).astype("Int64"), "equity": account[0] + account[1] * closes[at], "late": late[at]}
            if last_ts is not None and first + BLOCK_ROWS >= len(micros):
                self._store(last_ts, cash, pos, ind)
            yield pd.DataFrame(out)[self.names][~(warm[at] & ~late[at])]


def lookback_state(bars: DataFrame, n: int) -> DataFrame:
    """(symbol, tss, closes): the last ``n`` bars of each symbol, in order, as the state a stream starts from.

    Of a symbol at most ``n`` bars are gathered: the rank that leaves the others out is applied before the shuffle.
    """
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("ts")))
    last = bars.withColumn("_rank", rank).where(F.col("_rank") <= int(n))
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    rows = F.array_sort(F.collect_list(F.struct(micros.alias("ts"), F.col("close"))))
    return last.groupBy("symbol").agg(rows.alias("_bars")).select("symbol", F.col("_bars.ts").alias("tss"), F.col("_bars.close").alias("closes"))


def stream_strategy(bars: DataFrame, strategy: BarStrategy, starting_cash: float,
                    insolvency: str = "reference", warmup_col: str | None = None, initial: DataFrame | None = None) -> DataFrame:
    """Bars stream (``symbol, ts, close``) -> per-bar strategy rows.

    Warm-up (Y1 for streams), so the first live bar already sees full indicators: ``initial`` is a batch of the bars before the
    stream (``lookback_state``), applied when the run starts; with ``warmup_col``, bars of the stream where that boolean
    column is true only advance the indicator state: they never trade and are not emitted.
    """
    cols = ["symbol", "ts", "close"] + ([warmup_col] if warmup_col else [])
    processor = StrategyProcessor(strategy, float(starting_cash), insolvency == "halt", warmup_col)
    return bars.select(*cols).groupBy("symbol").transformWithStateInPandas(
        processor, output_schema(strategy), "Append", "None", initialState=None if initial is None else initial.groupBy("symbol"))
