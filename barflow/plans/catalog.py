"""Named queries over the driver's tables (one per operator family).

Every query reads whole tables. Doubles leaving a query are rounded with
``round_half_up`` (6 digits for indicators, 2 for money) so results compare
across engines; nothing else is rounded.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.columns import round_half_up
from barflow.operators.bars import latest_bars, ohlcv_bar_stream, ohlcv_bars
from barflow.operators.dedupe import dedupe_bar_stream, dedupe_bars
from barflow.operators import indicators as ind
from barflow.plans import report
from barflow.plans.custom import run_bar_strategy
from barflow.plans.strategies import (
    StrategyRun, ema_crossover, read_warmup, rsi_strategy, run_stored_range, series, sma_crossover, trim_warmup,
)
from barflow.plans.sweep import sweep_all, sweep_ema, sweep_rsi, sweep_sma
from barflow.schema import BAR_COLUMNS, BAR_SCHEMA, INDICATOR_DIGITS, MONEY_DIGITS, UPSTREAM_FIELDS
from barflow.session import default_parallelism, materialize, scratch_path
from barflow.sources.bar_index import bar_counts, read_bar_index, tick_bar_counts, write_bar_index
from barflow.sources.codec import decode_bars, encode_bars, normalise_ts, rename_bar_fields, split_quarantine
from barflow.sources.bar_table import read_bar_table, write_bar_table
from barflow.sources.scan import scan_bars_from_ticks, ticks_between
from barflow.sources.ticks import event_ticks, lineitem_ticks, order_ticks
from barflow.streaming.control import Run
from barflow.streaming.protocol import EmaCross, RsiThreshold, SmaCross
from barflow.streaming.replay import stage_frame_replay, stage_replay
from barflow.streaming.sinks import accumulate, batches, history, live_view, snapshot
from barflow.streaming.source import bar_stream, parsed_bars
from barflow.streaming.stateful import lookback_state, stream_strategy

# Fixed parameters of the catalog queries.
CASH = 1000.0            # reference UI default
RSI_CASH = 100000.0      # orders trade above 1000 per unit; a larger account trades
SHORT, LONG = 5, 30
RSI_N = 5
SWEEP_PAIRS = [(5, 30), (10, 50), (3, 20), (20, 60)]
RSI_SWEEP = [3, 5, 7, 14]
SCAN = ("A", "1996-01-01", "1996-12-31")
TABLE_SCAN = (["A", "R"], "1996-03-01", "1997-06-30")
WARMUP = ("1997-01-01", "1998-12-31")


def bars_L(spark, sf):
    return ohlcv_bars(lineitem_ticks(spark, sf), "1 day")


def bars_E(spark, sf):
    return ohlcv_bars(event_ticks(spark, sf), "1 hour")


def bars_O(spark, sf):
    return ohlcv_bars(order_ticks(spark, sf), "1 day")


def r6(c):
    return round_half_up(c, INDICATOR_DIGITS)


def r2(c):
    return round_half_up(c, MONEY_DIGITS)


def _bars_out(df: DataFrame) -> DataFrame:
    return df.select(*BAR_COLUMNS, "n_ticks")


def _final_out(bt: StrategyRun) -> DataFrame:
    f = bt.final
    return f.select(*bt.keys, "n_bars", "n_signals", "n_opened", r2("cash").alias("cash"), "pos",
                    "last_close", r2("final_value").alias("final_value"))


def _equity_out(bt: StrategyRun) -> DataFrame:
    return bt.equity.select(*bt.keys, "ts", "close", r2("cash").alias("cash"), "pos",
                            r2("equity").alias("equity"))


def q_bars_daily(spark, sf):
    return _bars_out(bars_L(spark, sf))


def q_bars_hourly(spark, sf):
    return _bars_out(bars_E(spark, sf))


def q_bars_orders(spark, sf):
    return _bars_out(bars_O(spark, sf))


def q_scan_range(spark, sf):
    """Symbol and date range pushed into the lineitem scan, then bars."""
    return _bars_out(scan_bars_from_ticks(lineitem_ticks(spark, sf), *SCAN, every="1 day"))


def q_bar_table(spark, sf):
    """Bars stored partitioned by symbol/year, read back for two symbols and a
    date range (partition pruning + ts pushdown)."""
    path = scratch_path(spark, "bar_tables", uuid.uuid4().hex)
    write_bar_table(bars_L(spark, sf), path)
    return read_bar_table(spark, path, *TABLE_SCAN)


def q_json_roundtrip(spark, sf):
    wire = encode_bars(bars_L(spark, sf))
    good, _bad = split_quarantine(normalise_ts(decode_bars(wire)))
    return good


def q_dedupe(spark, sf):
    b = bars_L(spark, sf).select(*BAR_COLUMNS)
    return dedupe_bars(b.unionByName(b))


def q_sma(spark, sf):
    f = ind.rolling_means(series(bars_L(spark, sf)), {"fast": SHORT, "slow": LONG}, with_prev=False)
    return f.select("symbol", "ts", "close", r6("fast").alias("fast"), r6("slow").alias("slow"))


def _gains(spark, sf):
    return ind.gains_losses(series(bars_O(spark, sf)), RSI_N)


def q_price_change(spark, sf):
    return _gains(spark, sf).select("symbol", "ts", "close", r2("price_change").alias("price_change"))


def q_gain_loss(spark, sf):
    return _gains(spark, sf).select("symbol", "ts", r2("gain").alias("gain"), r2("loss").alias("loss"))


def q_rolling_gain_loss(spark, sf):
    return _gains(spark, sf).select("symbol", "ts", r6("rolling_gain").alias("rolling_gain"),
                                    r6("rolling_loss").alias("rolling_loss"))


def q_ema(spark, sf):
    f = ind.ema(series(bars_L(spark, sf)), {"fast": SHORT, "slow": LONG}, with_prev=False)
    return f.select("symbol", "ts", "close", r6("fast").alias("fast"), r6("slow").alias("slow"))


def q_wilder(spark, sf):
    f = ind.wilder(_gains(spark, sf), RSI_N, with_prev=False)
    return f.select("symbol", "ts", r6("avg_gain").alias("avg_gain"), r6("avg_loss").alias("avg_loss"))


def q_rsi(spark, sf):
    f = ind.rsi(series(bars_O(spark, sf)), RSI_N)
    return f.select("symbol", "ts", "close", r6("rsi").alias("rsi"))


def bt_sma(spark, sf, **kw):
    return sma_crossover(bars_L(spark, sf), CASH, SHORT, LONG, **kw)


def bt_ema(spark, sf):
    return ema_crossover(bars_L(spark, sf), CASH, SHORT, LONG)


def bt_rsi(spark, sf):
    return rsi_strategy(bars_O(spark, sf), RSI_CASH, RSI_N)


def q_signal_sma(spark, sf):
    return bt_sma(spark, sf).frame.select("symbol", "ts", "sig")


def q_signal_ema(spark, sf):
    return bt_ema(spark, sf).frame.select("symbol", "ts", "sig")


def q_signal_rsi(spark, sf):
    return bt_rsi(spark, sf).frame.select("symbol", "ts", "sig")


def q_final_sma(spark, sf):
    return _final_out(bt_sma(spark, sf))


def q_final_sma_halt(spark, sf):
    return _final_out(bt_sma(spark, sf, insolvency="halt"))


def q_final_ema(spark, sf):
    return _final_out(bt_ema(spark, sf))


def q_final_rsi(spark, sf):
    return _final_out(bt_rsi(spark, sf))


def q_trades_sma(spark, sf):
    t = bt_sma(spark, sf).trades
    return t.select("symbol", "ts", "sig", "price", "closed", "opened", r2("cash").alias("cash"), "pos")


def q_equity_sma(spark, sf):
    return _equity_out(bt_sma(spark, sf))


def q_equity_ema(spark, sf):
    return _equity_out(bt_ema(spark, sf))


def q_equity_rsi(spark, sf):
    return _equity_out(bt_rsi(spark, sf))


def _stored_bars(spark, sf):
    """The reader and the bar index of the lineitem ticks: bars are made for the range that is asked for."""
    ticks = lineitem_ticks(spark, sf)
    return partial(ticks_between, ticks), materialize(tick_bar_counts(ticks), "bar-index")


def q_warmup_sma(spark, sf):
    """The look-back of LONG bars is a date first, so both dates reach the tick scan."""
    warm = read_warmup(*_stored_bars(spark, sf), *WARMUP, LONG)
    bt = sma_crossover(warm, CASH, SHORT, LONG)
    f = trim_warmup(bt.frame)
    return f.select("symbol", "ts", "close", r6("fast").alias("fast"), r6("slow").alias("slow"), "sig")


def q_range_run(spark, sf):
    """The form flow: one ticker, a date range, SMA 5/30 with warm-up, final value; only that range is read."""
    bt = run_stored_range(*_stored_bars(spark, sf), SCAN[0], *WARMUP, "sma", starting_cash=CASH, short_period=SHORT, long_period=LONG)
    return _final_out(bt)


def q_range_run_table(spark, sf):
    """The same from a bar table partitioned by symbol and year, with its index beside it."""
    path = scratch_path(spark, "bar_tables", uuid.uuid4().hex)
    write_bar_table(bars_L(spark, sf), f"{path}/bars")
    write_bar_index(bar_counts(read_bar_table(spark, f"{path}/bars")), f"{path}/index")
    bt = run_stored_range(partial(read_bar_table, spark, f"{path}/bars"), read_bar_index(spark, f"{path}/index"), SCAN[0], *WARMUP, "sma",
                          starting_cash=CASH, short_period=SHORT, long_period=LONG)
    return _final_out(bt)


def q_sweep_sma(spark, sf):
    bt = sweep_sma(bars_L(spark, sf), SWEEP_PAIRS, CASH)
    f = bt.final
    return f.select("symbol", "fast_period", "slow_period", "n_signals", "n_opened",
                    r2("final_value").alias("final_value"))


def q_sweep_ema(spark, sf):
    bt = sweep_ema(bars_L(spark, sf), SWEEP_PAIRS, CASH)
    f = bt.final
    return f.select("symbol", "fast_period", "slow_period", "n_signals", "n_opened",
                    r2("final_value").alias("final_value"))


def q_sweep_rsi(spark, sf):
    bt = sweep_rsi(bars_O(spark, sf), RSI_SWEEP, RSI_CASH)
    f = bt.final
    return f.select("symbol", "rsi_period", "n_signals", "n_opened", r2("final_value").alias("final_value"))


def q_sweep_all(spark, sf):
    """All three grids of the sweep queries in one plan and one ledger job (on L bars)."""
    bt = sweep_all(bars_L(spark, sf), SWEEP_PAIRS, SWEEP_PAIRS, RSI_SWEEP, CASH)
    f = bt.final
    return f.select("symbol", "strategy", "param_a", "param_b", "n_signals", "n_opened",
                    r2("final_value").alias("final_value"))


def q_chart_frame(spark, sf):
    c = report.chart_frame(bt_sma(spark, sf))
    return c.select("symbol", "ts", "open", "high", "low", "close", r6("fast").alias("fast"),
                    r6("slow").alias("slow"), "sig", r2("equity").alias("equity"))


def q_summary(spark, sf):
    s = report.summary(bt_sma(spark, sf))
    return s.select("symbol", "strategy", "n_signals", "n_opened", r2("final_value").alias("final_value"),
                    "text")


def _state_partitions(spark) -> int:
    """State-store partitions for the catalog's streams: the cluster's cores."""
    return default_parallelism(spark)


# Progress reports of the last replayed stream (for the bench).
LAST_PROGRESS: list[dict] = []


def _replay_through(spark, bars: DataFrame, make_output) -> tuple[Run, str]:
    """Replay ``bars`` slice by slice: the query runs over a slice of the stored messages on the run's
    checkpoint and ends before the next. Returns the run and the folder of its accumulated history."""
    run = Run(spark)
    rep = stage_replay(bars, f"{run.folder}/replay")
    hist = f"{run.folder}/history"
    LAST_PROGRESS.clear()
    for k in range(rep.n_slices):
        good, _dead = parsed_bars(rep.slice_stream(k, run.session))
        done = run.drain(make_output(good), foreach_batch=accumulate(hist, run.run_id), state_partitions=_state_partitions(spark))
        LAST_PROGRESS.extend(p for p in done if p.get("numInputRows", 0) > 0)
    return run, hist


def q_replay_sma(spark, sf):
    """S8 -> S1 -> S2/S3 -> S9, then E1 on the accumulated (deduplicated) history."""
    bars = bars_L(spark, sf).select(*BAR_COLUMNS)
    run, hist = _replay_through(spark, bars, lambda good: good)
    got = dedupe_bars(history(spark, hist, run.run_id).select(*BAR_COLUMNS))
    return _final_out(sma_crossover(got, CASH, SHORT, LONG))


def q_custom_ema(spark, sf):
    """Y5 in batch: the per-bar EMA strategy class run over whole symbols."""
    out = run_bar_strategy(bars_L(spark, sf), EmaCross(SHORT, LONG), CASH)
    return out.select("symbol", "ts", "close", r2("cash").alias("cash"), "pos", r2("equity").alias("equity"))


def q_custom_sma_chunked(spark, sf):
    """Y5 with a declared lookback: the per-bar SMA class over several chunks a symbol."""
    out = run_bar_strategy(bars_L(spark, sf), SmaCross(SHORT, LONG), CASH, chunk_rows=SMALL_CHUNK)
    return out.select("symbol", "ts", "close", r2("cash").alias("cash"), "pos", r2("equity").alias("equity"))


def q_custom_rsi(spark, sf):
    """Y5 without a lookback: the per-bar RSI class, a symbol's bars in order."""
    out = run_bar_strategy(bars_O(spark, sf), RsiThreshold(RSI_N), RSI_CASH)
    return out.select("symbol", "ts", "close", r2("cash").alias("cash"), "pos", r2("equity").alias("equity"))


def _stream_equity(spark, bars: DataFrame, strategy, cash: float) -> DataFrame:
    run, hist = _replay_through(spark, bars, lambda good: stream_strategy(good, strategy, cash))
    out = history(spark, hist, run.run_id)
    late = out.filter("late").count()
    if late:
        raise RuntimeError(f"{late} bars came after later bars of their symbol")
    return out.select("symbol", "ts", "close", r2("cash").alias("cash"), "pos", r2("equity").alias("equity"))


def q_stream_ema(spark, sf):
    """EMA crossover evaluated bar by bar with per-symbol state."""
    return _stream_equity(spark, bars_L(spark, sf).select(*BAR_COLUMNS), EmaCross(SHORT, LONG), CASH)


def q_stream_sma(spark, sf):
    """SMA crossover bar by bar (state: ring of the last LONG closes)."""
    return _stream_equity(spark, bars_L(spark, sf).select(*BAR_COLUMNS), SmaCross(SHORT, LONG), CASH)


def q_stream_rsi(spark, sf):
    """RSI strategy bar by bar on the orders series."""
    return _stream_equity(spark, bars_O(spark, sf).select(*BAR_COLUMNS), RsiThreshold(RSI_N), RSI_CASH)


def q_stream_warmup_sma(spark, sf):
    """Y1 for streams: the bars from the range's start on are streamed; the ones before are the stream's initial state."""
    bars = bars_L(spark, sf).select(*BAR_COLUMNS)
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in WARMUP)
    before = lookback_state(bars.where(F.col("ts") < lo), LONG)
    live = bars.where((F.col("ts") >= lo) & (F.col("ts") < hi + F.expr("INTERVAL 1 DAY")))
    run, hist = _replay_through(spark, live, lambda good: stream_strategy(good, SmaCross(SHORT, LONG), CASH, initial=before))
    return history(spark, hist, run.run_id).select("symbol", "ts", "close", r6("fast").alias("fast"), r6("slow").alias("slow"), "sig")


def q_bars_stream_hourly(spark, sf):
    """S7 on a stream: event ticks replayed in time slices, hourly windows with a
    watermark in update mode, history compacted to the last version per bar."""
    run = Run(spark)
    rep = stage_frame_replay(event_ticks(spark, sf), f"{run.folder}/ticks")
    hist = f"{run.folder}/history"
    for k in range(rep.n_slices):
        run.drain(ohlcv_bar_stream(rep.slice_stream(k, run.session), "1 hour", "1 hour"), foreach_batch=accumulate(hist, run.run_id),
                  output_mode="update", state_partitions=_state_partitions(spark))
    return latest_bars(history(spark, hist, run.run_id)).select(*BAR_COLUMNS, "n_ticks")


def q_final_ema_hourly(spark, sf):
    """E2 on hourly bars of the events table."""
    return _final_out(ema_crossover(bars_E(spark, sf), CASH, SHORT, LONG))


def q_final_sma_orders(spark, sf):
    """E1 on daily bars of the orders table (larger account: prices exceed 1000)."""
    return _final_out(sma_crossover(bars_O(spark, sf), RSI_CASH, SHORT, LONG))


# Rows per chunk of the *_chunked and *_scan queries: small, so that every symbol spans several chunks.
SMALL_CHUNK = 500
# Closes of bars whose index is a multiple of this are blanked for the gap queries.
GAP_EVERY = 7


def q_sma_chunked(spark, sf):
    """I1 with several chunks a symbol."""
    f = ind.rolling_means(series(bars_L(spark, sf)), {"fast": SHORT, "slow": LONG}, with_prev=False, chunk_rows=SMALL_CHUNK)
    return f.select("symbol", "ts", "close", r6("fast").alias("fast"), r6("slow").alias("slow"))


def q_ema_scan(spark, sf):
    """The EMA by the affine scan over several chunks a symbol."""
    f = ind.ema(series(bars_L(spark, sf)), {"fast": SHORT, "slow": LONG}, with_prev=False, method="scan", chunk_rows=SMALL_CHUNK)
    return f.select("symbol", "ts", "close", r6("fast").alias("fast"), r6("slow").alias("slow"))


def q_wilder_scan(spark, sf):
    """The Wilder averages by the affine scan over several chunks a symbol."""
    f = ind.wilder(_gains(spark, sf), RSI_N, with_prev=False, method="scan", chunk_rows=SMALL_CHUNK)
    return f.select("symbol", "ts", r6("avg_gain").alias("avg_gain"), r6("avg_loss").alias("avg_loss"))


def q_equity_chunked(spark, sf):
    """P4 with several chunks a symbol."""
    return _equity_out(bt_sma(spark, sf, chunk_rows=SMALL_CHUNK))


def _gapped(spark, sf):
    bars = series(bars_L(spark, sf))
    return bars.withColumn("close", F.when(F.col("seq") % GAP_EVERY != 0, F.col("close")))


def q_ema_gaps(spark, sf):
    """I2 where closes are missing: after k missing ones the carried mean weighs (1-a)^(k+1)."""
    f = ind.ema(_gapped(spark, sf), {"fast": SHORT, "slow": LONG}, with_prev=False)
    return f.select("symbol", "ts", "close", r6("fast").alias("fast"), r6("slow").alias("slow"))


def q_ema_gaps_chunked(spark, sf):
    """The same with several chunks a symbol."""
    f = ind.ema(_gapped(spark, sf), {"fast": SHORT, "slow": LONG}, with_prev=False, chunk_rows=SMALL_CHUNK)
    return f.select("symbol", "ts", "close", r6("fast").alias("fast"), r6("slow").alias("slow"))


def q_stream_dedupe(spark, sf):
    """Every message comes twice; the query is restarted on its checkpoint for each slice."""
    bars = bars_L(spark, sf).select(*BAR_COLUMNS)
    run, hist = _replay_through(spark, bars.unionByName(bars), lambda good: dedupe_bar_stream(good, 5 * 86_400, 86_400))
    return history(spark, hist, run.run_id).select(*BAR_COLUMNS)


def _streamed_bars(spark, sf):
    """A run whose history is the bars as they came, in batches."""
    return _replay_through(spark, bars_L(spark, sf).select(*BAR_COLUMNS), lambda good: good)


def q_snapshot_sma(spark, sf):
    """The strategy on everything received so far."""
    run, hist = _streamed_bars(spark, sf)
    got = snapshot(spark, hist, run.run_id).drop("batch_id")
    return _final_out(sma_crossover(got, CASH, SHORT, LONG))


def q_live_view_bars(spark, sf):
    """The run's finished batches, queried by the view's name."""
    run, hist = _streamed_bars(spark, sf)
    name = f"live_{run.run_id}"
    live_view(spark, hist, run.run_id, name, BAR_SCHEMA)
    return spark.sql(f"SELECT symbol, count(*) AS n_bars, min(low) AS low, max(high) AS high, sum(volume) AS volume FROM {name} GROUP BY symbol")


def q_batch_rows(spark, sf):
    """New rows of each micro-batch, a batch for each slice."""
    run, hist = _streamed_bars(spark, sf)
    return batches(spark, hist, run.run_id).select("batch_id", "n_rows")


def q_trigger_bars(spark, sf):
    """A query that stays up on a processing-time trigger, its interval raised to the floor; slices arrive while it runs."""
    run = Run(spark)
    rep = stage_replay(bars_L(spark, sf).select(*BAR_COLUMNS), f"{run.folder}/replay")
    hist = f"{run.folder}/history"
    rep.feed(0)
    good, _dead = parsed_bars(bar_stream(run.session, rep.source))
    query = run.start(good, foreach_batch=accumulate(hist, run.run_id), interval_ms=10, floor_ms=200)
    try:
        query.processAllAvailable()
        for k in range(1, rep.n_slices):
            rep.feed(k)
            query.processAllAvailable()
    finally:
        run.stop()
    return history(spark, hist, run.run_id).select(*BAR_COLUMNS)


# Messages of bars of these days of the month are damaged for the dead-letter query: cut short, or given a close of 0.
CUT_DAY, ZERO_DAY = 13, 7


def q_dead_letters(spark, sf):
    """Messages that are no bar go to the dead letters and say why as far as it can be told."""
    bars = bars_L(spark, sf)
    zeroed = bars.withColumn("close", F.when(F.dayofmonth("ts") == ZERO_DAY, F.lit(0.0)).otherwise(F.col("close")))
    cut = F.dayofmonth("ts") == CUT_DAY
    wire = encode_bars(zeroed.withColumn("_cut", cut), keep=("_cut",))
    text = F.col("value").cast("string")
    wire = wire.withColumn("value", F.when(F.col("_cut"), F.substring(text, 1, 20)).otherwise(text).cast("binary"))
    _good, dead = split_quarantine(normalise_ts(decode_bars(wire)))
    return dead.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_dead"), F.count(F.when(F.col("ts").isNull(), 1)).alias("n_unread"),
                                      F.count(F.when(F.col("close") <= 0, 1)).alias("n_bad_close"))


def q_json_millis(spark, sf):
    """S3 with ``keep_millis``: the sub-second part of the message's time stays."""
    bars = bars_L(spark, sf)
    shifted = bars.withColumn("ts", F.expr("timestampadd(MILLISECOND, cast(volume % 1000 AS INT), ts)"))
    good, _bad = split_quarantine(normalise_ts(decode_bars(encode_bars(shifted)), keep_millis=True))
    return good


# Runs of 2 to 40 missing closes, one at the begin of every block of bars.
GAP_BLOCK, LONGEST_GAP = 64, 40


def _gap_runs(spark, sf):
    bars = series(bars_L(spark, sf))
    run = 2 + F.floor(F.col("seq") / GAP_BLOCK) % (LONGEST_GAP - 1)
    return bars.withColumn("close", F.when(F.col("seq") % GAP_BLOCK >= run, F.col("close")))


def q_ema_gap_runs(spark, sf):
    """I2 after k missing closes, for k of 2 to 40."""
    f = ind.ema(_gap_runs(spark, sf), {"fast": SHORT, "slow": LONG}, with_prev=False)
    return f.select("symbol", "ts", "close", r6("fast").alias("fast"), r6("slow").alias("slow"))


def q_ema_gap_runs_chunked(spark, sf):
    """The same with several chunks a symbol, which begin inside runs too."""
    f = ind.ema(_gap_runs(spark, sf), {"fast": SHORT, "slow": LONG}, with_prev=False, chunk_rows=SMALL_CHUNK + 12)
    return f.select("symbol", "ts", "close", r6("fast").alias("fast"), r6("slow").alias("slow"))


def q_upstream_fields(spark, sf):
    """Bars under the upstream's short field names, renamed to the long ones."""
    short = {long: name for name, long in UPSTREAM_FIELDS.items()}
    bars = bars_L(spark, sf).withColumnRenamed("ts", "timestamp").drop("n_ticks").withColumnsRenamed(short)
    return rename_bar_fields(bars).withColumnRenamed("timestamp", "ts").select(*BAR_COLUMNS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bars_daily": q_bars_daily,
    "bars_hourly": q_bars_hourly,
    "bars_orders": q_bars_orders,
    "scan_range": q_scan_range,
    "bar_table": q_bar_table,
    "json_roundtrip": q_json_roundtrip,
    "dedupe": q_dedupe,
    "sma": q_sma,
    "price_change": q_price_change,
    "gain_loss": q_gain_loss,
    "rolling_gain_loss": q_rolling_gain_loss,
    "ema": q_ema,
    "wilder": q_wilder,
    "rsi": q_rsi,
    "signal_sma": q_signal_sma,
    "signal_ema": q_signal_ema,
    "signal_rsi": q_signal_rsi,
    "final_sma": q_final_sma,
    "final_sma_halt": q_final_sma_halt,
    "final_ema": q_final_ema,
    "final_rsi": q_final_rsi,
    "trades_sma": q_trades_sma,
    "equity_sma": q_equity_sma,
    "equity_ema": q_equity_ema,
    "equity_rsi": q_equity_rsi,
    "warmup_sma": q_warmup_sma,
    "range_run": q_range_run,
    "sweep_sma": q_sweep_sma,
    "sweep_ema": q_sweep_ema,
    "sweep_rsi": q_sweep_rsi,
    "sweep_all": q_sweep_all,
    "chart_frame": q_chart_frame,
    "summary": q_summary,
    "bars_stream_hourly": q_bars_stream_hourly,
    "final_ema_hourly": q_final_ema_hourly,
    "final_sma_orders": q_final_sma_orders,
    "replay_sma": q_replay_sma,
    "custom_ema": q_custom_ema,
    "custom_sma_chunked": q_custom_sma_chunked,
    "custom_rsi": q_custom_rsi,
    "stream_ema": q_stream_ema,
    "stream_warmup_sma": q_stream_warmup_sma,
    "stream_sma": q_stream_sma,
    "stream_rsi": q_stream_rsi,
    "sma_chunked": q_sma_chunked,
    "ema_scan": q_ema_scan,
    "wilder_scan": q_wilder_scan,
    "equity_chunked": q_equity_chunked,
    "ema_gaps": q_ema_gaps,
    "ema_gaps_chunked": q_ema_gaps_chunked,
    "stream_dedupe": q_stream_dedupe,
    "upstream_fields": q_upstream_fields,
    "range_run_table": q_range_run_table,
    "snapshot_sma": q_snapshot_sma,
    "live_view_bars": q_live_view_bars,
    "batch_rows": q_batch_rows,
    "trigger_bars": q_trigger_bars,
    "dead_letters": q_dead_letters,
    "json_millis": q_json_millis,
    "ema_gap_runs": q_ema_gap_runs,
    "ema_gap_runs_chunked": q_ema_gap_runs_chunked,
}
