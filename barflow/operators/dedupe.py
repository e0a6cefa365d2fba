"""Drop repeated bars (at-least-once delivery repeats whole messages)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor


def dedupe_bars(bars: DataFrame, keys=("symbol", "ts")) -> DataFrame:
    """Batch: one row per (symbol, ts), the least by the other columns if they differ,
    so the survivor does not depend on the partitioning. An aggregate on a near-unique
    key, pre-aggregated map-side."""
    ks = list(keys)
    rest = [c for c in bars.columns if c not in ks]
    if not rest:
        return bars.distinct()
    kept = bars.groupBy(*ks).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*ks, "_kept.*").select(*bars.columns)


SPANS = T.StructType([T.StructField("newest", T.LongType()), T.StructField("los", T.ArrayType(T.LongType())),
                      T.StructField("his", T.ArrayType(T.LongType()))])


def unseen(los: np.ndarray, his: np.ndarray, ts: np.ndarray) -> np.ndarray:
    """Which of ``ts`` lie in none of the spans [lo, hi] (ascending, apart)."""
    at = np.searchsorted(los, ts, side="right") - 1
    return (at < 0) | (ts > his[np.maximum(at, 0)]) if len(los) else np.ones(len(ts), dtype=bool)


def merge_spans(los: np.ndarray, his: np.ndarray, ts: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The spans with the points ``ts`` in them; spans at most ``step`` apart become one."""
    lo, hi = np.append(los, ts), np.append(his, ts)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.append(True, lo[1:] > hi[:-1] + step)[:len(lo)]
    last = np.append(first[1:], True)[:len(lo)]
    return lo[first], hi[last]


class SeenBars(StatefulProcessor):
    """One symbol's bars: what was seen is kept as merged spans of time, in one state row."""

    def __init__(self, delay: int, step: int):
        self.delay, self.step = delay, step

    def init(self, handle) -> None:
        self.spans = handle.getValueState("spans", SPANS)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        newest, los, his = self.spans.get() if self.spans.exists() else (None, [], [])
        los, his = np.array(los, dtype=np.int64), np.array(his, dtype=np.int64)
        # As with a watermark, what is too late follows from the batches before.
        floor = None if newest is None else newest - self.delay
        for pdf in rows:
            pdf = pdf.sort_values([c for c in pdf.columns if c != "symbol"], kind="stable")
            ts = pdf["ts"].astype("datetime64[us]").astype("int64").to_numpy()
            take = unseen(los, his, ts) & np.append(True, ts[1:] != ts[:-1])[:len(ts)]
            if floor is not None:
                take &= ts >= floor
            if take.any():
                los, his = merge_spans(los, his, ts[take], self.step)
                newest = max(int(ts[take].max()), newest if newest is not None else int(ts[take].max()))
                yield pdf[take]
        if newest is not None:
            kept = his >= newest - self.delay
            self.spans.update((newest, los[kept].tolist(), his[kept].tolist()))


def dedupe_bar_stream(stream: DataFrame, delay_seconds: int = 86_400, every_seconds: int = 0) -> DataFrame:
    """Stream: of the bars of one (symbol, ts) the first is kept, however often it is delivered again.

    A symbol has one state row: the spans of time it has bars of, as merged intervals. Bars are ``every_seconds``
    apart (0: unknown, each is a span of its own), so a run of bars without gaps is one span whatever its length. A bar
    more than ``delay_seconds`` older than the newest one of the micro-batches before is too late and dropped, seen or not, and
    spans that old are forgotten: the state holds at most the gaps of that time. Rows pass Arrow batch by
    Arrow batch; of repeats in one, the least by the other columns is kept.

    The run must use the RocksDB state store (``streaming.control.Run`` sees to it).
    """
    processor = SeenBars(int(delay_seconds) * 1_000_000, int(every_seconds) * 1_000_000)
    return stream.groupBy("symbol").transformWithStateInPandas(processor, stream.schema, "Append", "None")
