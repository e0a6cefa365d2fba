"""The all-in position ledger.

P1 is a fold: integer share counts make the step non-associative, so the
signals of one (symbol, parameter set), a lane, are applied in order. Only
signal rows enter it; lanes are dealt to tasks by a hash of their key, a task's
rows are sorted by the bar index, so its lanes are interleaved, and
``mapInPandas`` streams them batch by batch with two numbers of state a lane.
In a batch the lanes step together (``lockstep``): step k takes the k-th signal
of every lane as arrays, so the work in Python is one step for each signal of
the busiest lane, not one for each row.

P3 (final value) and P4 (equity) are joins and scans around the fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators.sequence import CHUNK, DEFAULT_CHUNK_ROWS, _keys, chunk_of, join_on

INSOLVENCY_MODES = ("reference", "halt")


def ledger_step(cash: float, pos: int, sig: int, price: float, halt: bool = False):
    """One signal at ``price``. Returns (cash, pos, closed, opened).

    Opposite side held -> close it at price. Flat -> open sig·trunc(cash/price)
    shares (``halt``: open nothing while cash <= 0). Same side held -> nothing.
    """
    closed = 0
    if pos * sig < 0:
        cash += pos * price
        closed = pos
        pos = 0
    opened = 0
    if pos == 0 and not (halt and cash <= 0):
        n = int(cash / price)
        if sig > 0:
            pos = n
            cash -= n * price
        else:
            pos = -n
            cash += n * price
        opened = pos
    return cash, pos, closed, opened


def lockstep(cash: np.ndarray, pos: np.ndarray, lane: np.ndarray, sig: np.ndarray, price: np.ndarray, halt: bool = False):
    """``ledger_step`` on many lanes at once: one signal a row, the rows of a lane in order.

    ``cash`` and ``pos`` hold each lane's state and are updated. The k-th rows of all lanes form
    round k, and a round is one step of arrays. Returns (cash, pos, closed, opened) of each row.
    """
    n = len(lane)
    by_lane = np.argsort(lane, kind="stable")
    of = lane[by_lane]
    first = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if n else np.empty(0, dtype=np.int64)
    rank = np.empty(n, dtype=np.int64)
    rank[by_lane] = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    order = np.argsort(rank, kind="stable")
    bounds = np.append(np.flatnonzero(np.append(True, np.diff(rank[order]) > 0)), n) if n else [0]
    lanes, sigs, prices = lane[order], np.sign(sig[order]).astype(np.float64), price[order]
    out = np.empty((4, n))
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        at, side, x = lanes[lo:hi], sigs[lo:hi], prices[lo:hi]
        c, held = cash[at], pos[at]
        closed = np.where(held * side < 0, held, 0.0)
        c = c + closed * x
        held = held - closed
        shares = np.trunc(c / x)
        # Whole shares in the signal's direction, from flat only.
        opened = np.where((held == 0) & (c > 0) if halt else held == 0, side * shares, 0.0)
        c = c - opened * x
        held = held + opened
        cash[at], pos[at] = c, held
        out[0, lo:hi], out[1, lo:hi], out[2, lo:hi], out[3, lo:hi] = c, held, closed, opened
    if n and np.abs(out[1:]).max() >= 2.0**53:
        raise OverflowError("a position of 2**53 shares or more is not exact")
    rows = np.empty_like(out)
    rows[:, order] = out
    return rows[0], *(r.astype(np.int64) for r in rows[1:])


def _fold_batches(batches, keys, starting_cash, halt):
    """Signals by bar index, all lanes of the task interleaved; its state is two numbers a lane."""
    lanes: dict = {}
    cash, pos = np.empty(0), np.empty(0)
    for pdf in batches:
        if pdf.empty:
            continue
        groups = pdf.groupby(keys, sort=False, dropna=False)
        code = groups.ngroup().to_numpy()
        seen = pdf[keys].iloc[np.sort(np.unique(code, return_index=True)[1])]
        named = seen.astype(object).where(seen.notna(), None).itertuples(index=False, name=None)
        lane = np.array([lanes.setdefault(k, len(lanes)) for k in named], dtype=np.int64)
        more = len(lanes) - len(cash)
        if more:
            cash, pos = np.append(cash, np.full(more, starting_cash)), np.append(pos, np.zeros(more))
        after = lockstep(cash, pos, lane[code], pdf["sig"].to_numpy(), pdf["price"].to_numpy(dtype=np.float64), halt)
        yield pdf.assign(**{c: v for c, v in zip(("cash", "pos", "closed", "opened"), after, strict=True)})[[*pdf.columns, "closed", "opened", "cash", "pos"]]


def run_ledger(frame: DataFrame, starting_cash: float, keys: Sequence[str] | str = ("symbol",),
               seq: str = "seq", insolvency: str = "reference") -> DataFrame:
    """One row per signal with the state after it.

    Columns: keys, seq, ts, sig, price, closed (shares closed, signed),
    opened (shares opened, signed), cash, pos.
    """
    if insolvency not in INSOLVENCY_MODES:
        raise ValueError(f"insolvency must be one of {INSOLVENCY_MODES}")
    ks = _keys(keys)
    rows = (frame.filter(F.col("sig") != 0)
            .select(*ks, seq, "ts", F.col("sig").cast("int").alias("sig"), F.col("close").alias("price")))
    rows = rows.repartition(*ks).sortWithinPartitions(seq, *ks)
    schema = T.StructType(rows.schema.fields + [
        T.StructField("closed", T.LongType()), T.StructField("opened", T.LongType()),
        T.StructField("cash", T.DoubleType()), T.StructField("pos", T.LongType())])
    fold = partial(_fold_batches, keys=ks, starting_cash=float(starting_cash), halt=(insolvency == "halt"))
    return rows.mapInPandas(fold, schema)


def final_values(frame: DataFrame, trades: DataFrame, starting_cash: float,
                 keys: Sequence[str] | str = ("symbol",), seq: str = "seq") -> DataFrame:
    """P3 + R6: cash + pos · last close per key; keys without trades keep their cash.

    Bars and trades go through one aggregate together (decomposable, with map-side
    partials): one shuffle of at most one row per key and task.
    """
    ks = _keys(keys)
    null = F.lit(None)
    bars = frame.select(*ks, F.struct(seq, "close").alias("_bar"), (F.col("sig") != 0).cast("long").alias("_sig"),
                        null.cast(f"struct<{seq}:bigint,cash:double,pos:bigint>").alias("_state"), null.cast("long").alias("_open"))
    states = trades.select(*ks, null.cast(bars.schema["_bar"].dataType).alias("_bar"), null.cast("long").alias("_sig"),
                           F.struct(F.col(seq).cast("long").alias(seq), "cash", "pos").alias("_state"),
                           (F.col("opened") != 0).cast("long").alias("_open"))
    zero = F.lit(0).cast("long")
    j = bars.unionByName(states).groupBy(*ks).agg(
        F.max_by("_bar", f"_bar.{seq}").alias("_bar"), F.count("_bar").alias("n_bars"),
        F.coalesce(F.sum("_sig"), zero).alias("n_signals"), F.max_by("_state", f"_state.{seq}").alias("_state"),
        F.coalesce(F.sum("_open"), zero).alias("n_opened"))
    cash = F.coalesce(F.col("_state.cash"), F.lit(float(starting_cash)))
    pos = F.coalesce(F.col("_state.pos"), zero)
    return j.select(*ks, "n_bars", "n_signals", "n_opened", cash.alias("cash"), pos.alias("pos"),
                    F.col("_bar.close").alias("last_close"), (cash + pos * F.col("_bar.close")).alias("final_value"))


def sweep_final_values(bars: DataFrame, signals: DataFrame, trades: DataFrame, grid: Sequence[dict], starting_cash: float,
                       keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """P3 for a grid of parameter sets: last close and bar count once per series, then one row per set.

    ``keys`` are the series keys followed by the columns of ``grid``. ``bars`` need no index: the last bar is
    the one of the latest ``ts``, the greatest of equal ones. The rows of all three inputs
    go through one aggregate together.
    """
    sets = list(grid[0])
    series = [k for k in keys if k not in sets]
    latest = F.max(F.struct(*[c for c in bars.columns if c not in series])).alias("_bar")
    last = bars.groupBy(*series).agg(latest, F.count(F.lit(1)).alias("n_bars")).select(*series, F.col("_bar.close").alias("last_close"), "n_bars")
    each = F.explode(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in g.items()]) for g in grid])).alias("_g")
    null = F.lit(None)
    state = f"struct<{seq}:bigint,cash:double,pos:bigint>"
    rows = last.select(*series, "last_close", "n_bars", each).select(
        *series, "_g.*", "last_close", "n_bars", null.cast("long").alias("_sig"), null.cast(state).alias("_state"),
        null.cast("long").alias("_open"))
    marks = signals.select(*keys, null.cast("double").alias("last_close"), null.cast("long").alias("n_bars"), F.lit(1).cast("long").alias("_sig"),
                           null.cast(state).alias("_state"), null.cast("long").alias("_open"))
    states = trades.select(*keys, null.cast("double").alias("last_close"), null.cast("long").alias("n_bars"), null.cast("long").alias("_sig"),
                           F.struct(F.col(seq).cast("long").alias(seq), "cash", "pos").alias("_state"),
                           (F.col("opened") != 0).cast("long").alias("_open"))
    zero = F.lit(0).cast("long")
    j = rows.unionByName(marks).unionByName(states).groupBy(*keys).agg(
        F.max("last_close").alias("last_close"), F.max("n_bars").alias("n_bars"), F.coalesce(F.sum("_sig"), zero).alias("n_signals"),
        F.max_by("_state", f"_state.{seq}").alias("_state"), F.coalesce(F.sum("_open"), zero).alias("n_opened"))
    cash = F.coalesce(F.col("_state.cash"), F.lit(float(starting_cash)))
    pos = F.coalesce(F.col("_state.pos"), zero)
    return j.select(*keys, "n_bars", "n_signals", "n_opened", cash.alias("cash"), pos.alias("pos"), "last_close",
                    (cash + pos * F.col("last_close")).alias("final_value"))


def equity_curve(frame: DataFrame, trades: DataFrame, starting_cash: float,
                 keys: Sequence[str] | str = ("symbol",), seq: str = "seq",
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Per bar, the state after the latest signal at or before it and
    equity = cash + pos · close.

    Bars, trades and the state that enters each chunk are rows of one frame dealt by
    (key, chunk): one large shuffle, one window. The entering states come from the
    trades alone (the last one of a chunk holds until the next chunk with one).
    """
    ks = _keys(keys)
    chunk = chunk_of(seq, chunk_rows)
    state = F.struct("cash", "pos")
    bars = frame.select(*ks, F.col(seq).cast("long").alias("_at"), chunk.alias(CHUNK), F.lit(2).alias("_kind"),
                        F.struct(*frame.columns).alias("_bar"))
    none = F.lit(None).cast(bars.schema["_bar"].dataType)
    empty = F.lit(None).cast("struct<cash:double,pos:bigint>")
    marks = trades.select(*ks, F.col(seq).cast("long").alias("_at"), chunk.alias(CHUNK), F.lit(1).alias("_kind"), none.alias("_bar"), state.alias("_state"))
    ends = marks.groupBy(*ks, CHUNK).agg(F.max_by("_state", "_at").alias("_state"))
    last = join_on(ends, frame.groupBy(*ks).agg(F.max(chunk).alias("_last")), ks)
    following = F.lead(CHUNK).over(Window.partitionBy(*ks).orderBy(CHUNK))
    until = F.coalesce(following, F.col("_last"))
    entering = (last.withColumn("_to", until).where(F.col("_to") > F.col(CHUNK))
                .withColumn(CHUNK, F.explode(F.sequence(F.col(CHUNK) + 1, F.col("_to"))))
                .select(*ks, (F.col(CHUNK) * int(chunk_rows)).cast("long").alias("_at"), CHUNK, F.lit(0).alias("_kind"), none.alias("_bar"), "_state"))
    order = Window.partitionBy(*ks, CHUNK).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    filled = (bars.withColumn("_state", empty).unionByName(marks).unionByName(entering)
              .withColumn("_state", F.last("_state", ignorenulls=True).over(order)).where("_kind = 2"))
    cash = F.coalesce(F.col("_state.cash"), F.lit(float(starting_cash)))
    pos = F.coalesce(F.col("_state.pos"), F.lit(0).cast("long"))
    return (filled.select("_bar.*", cash.alias("cash"), pos.alias("pos"))
            .withColumn("equity", F.col("cash") + F.col("pos") * F.col("close")))
