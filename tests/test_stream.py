"""Stream = batch: replayed slices, restart on the same checkpoint, duplicates."""

from pyspark.sql import functions as F

from conftest import SF001

from barflow.operators.bars import ohlcv_bars
from barflow.plans.strategies import ema_crossover, rsi_strategy, sma_crossover
from barflow.schema import BAR_COLUMNS
from barflow.sources.ticks import lineitem_ticks, order_ticks
from barflow.streaming.control import Run
from barflow.streaming.protocol import EmaCross, RsiThreshold, SmaCross
from barflow.streaming.replay import stage_replay
from barflow.streaming.sinks import accumulate, batches, history, live_view, snapshot
from barflow.streaming.source import bar_stream, parsed_bars
from barflow.streaming.stateful import stream_strategy


def _run_stream(spark, bars, strategy, cash, slices=3, restart_after=1, duplicate_slice=None):
    run = Run(spark)
    rep = stage_replay(bars, f"{run.folder}/replay", slices)
    hist = f"{run.folder}/history"

    def start():
        good, _ = parsed_bars(bar_stream(run.session, rep.source))
        return run.start(stream_strategy(good, strategy, cash), foreach_batch=accumulate(hist, run.run_id))

    rep.feed(0)
    q = start()
    q.processAllAvailable()
    for k in range(1, slices):
        if k == restart_after:
            run.stop()
            q = start()  # same checkpoint: resumes, state kept
        rep.feed(k)
        q.processAllAvailable()
        if duplicate_slice == k:
            rep.feed(k)  # at-least-once: the same messages again
            q.processAllAvailable()
    run.stop()
    return history(spark, hist, run.run_id)


def _compare(stream_rows, batch_rows, cols):
    s = {(r["symbol"], r["ts"]): tuple(r[c] for c in cols) for r in stream_rows}
    b = {(r["symbol"], r["ts"]): tuple(r[c] for c in cols) for r in batch_rows}
    assert s.keys() == b.keys()
    for k in b:
        for x, y in zip(s[k], b[k]):
            assert (x is None and y is None) or abs(x - y) <= 1e-9 * max(1, abs(y)), (k, s[k], b[k])


def test_stream_ema_equals_batch_with_restart_and_duplicates(spark):
    from barflow.streaming.protocol import make_strategy
    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    out = _run_stream(spark, bars, make_strategy("ema", short_period=5, long_period=30), 1000.0,
                      duplicate_slice=2)
    late = out.filter("late").count()
    assert late > 0  # the repeated slice is flagged, not applied
    batch = ema_crossover(bars, 1000.0, 5, 30).equity
    _compare(out.filter(~F.col("late")).collect(), batch.collect(), ["fast", "slow", "sig", "cash", "pos", "equity"])


def test_stream_sma_and_rsi_equal_batch(spark):
    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    out = _run_stream(spark, bars, SmaCross(5, 30), 1000.0)
    _compare(out.collect(), sma_crossover(bars, 1000.0, 5, 30).equity.collect(), ["fast", "slow", "sig", "equity"])
    obars = ohlcv_bars(order_ticks(spark, SF001)).select(*BAR_COLUMNS)
    out = _run_stream(spark, obars, RsiThreshold(5), 100000.0)
    _compare(out.collect(), rsi_strategy(obars, 100000.0, 5).equity.collect(), ["rsi", "sig", "equity"])


def test_live_view_and_snapshot(spark):
    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    run = Run(spark)
    hist = f"{run.folder}/history"
    rep = stage_replay(bars, f"{run.folder}/replay", 2)

    def drain(_k):
        good, _ = parsed_bars(bar_stream(run.session, rep.source))
        run.drain(good, foreach_batch=accumulate(hist, run.run_id))

    rep.feed_all(after_each=drain)
    live_view(spark, hist, run.run_id, "live_bars", bars.schema)
    assert spark.table("live_bars").count() == bars.count()
    stamps = [r["ts"] for r in snapshot(spark, hist, run.run_id).collect()]
    assert stamps == sorted(stamps) and len(stamps) == bars.count()


def test_replay_of_many_files_a_slice_loses_nothing(spark):
    """Slices of many files each: a drained slice is read whole, so nothing comes late."""
    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    bars = spark.createDataFrame(bars.toPandas(), bars.schema).repartition(64)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    for k in old:
        spark.conf.set(k, "false")
    try:
        run = Run(spark)
        hist = f"{run.folder}/history"
        rep = stage_replay(bars, f"{run.folder}/replay", 3)

        def drain(_k):
            good, _ = parsed_bars(bar_stream(run.session, rep.source))
            run.drain(stream_strategy(good, EmaCross(5, 30), 1000.0), foreach_batch=accumulate(hist, run.run_id))

        rep.feed_all(after_each=drain)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    out = history(spark, hist, run.run_id)
    assert out.filter("late").count() == 0
    _compare(out.collect(), ema_crossover(bars, 1000.0, 5, 30).equity.collect(), ["fast", "slow", "sig", "equity"])


def test_dedupe_stream_and_publish_roundtrip(spark):
    from barflow.operators.dedupe import dedupe_bar_stream
    from barflow.streaming.publish import publish_bars

    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    run = Run(spark)
    src = f"{run.folder}/published"
    publish_bars(bars, src)
    publish_bars(bars, src)  # every message twice
    good, _ = parsed_bars(bar_stream(run.session, src))
    hist = f"{run.folder}/history"
    run.drain(dedupe_bar_stream(good, 30 * 86_400, 86_400), foreach_batch=accumulate(hist, run.run_id))
    got = history(spark, hist, run.run_id)
    assert got.count() == bars.count()
    state = spark.read.format("statestore").option("stateVarName", "spans").load(run.checkpoint)
    assert state.count() == bars.select("symbol").distinct().count()  # one row a symbol, whatever the number of bars
    assert got.select(*BAR_COLUMNS).exceptAll(bars).count() == 0


def test_available_now_runs_resume_from_checkpoint(spark):
    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    run = Run(spark)
    rep = stage_replay(bars, f"{run.folder}/replay", 3)
    hist = f"{run.folder}/history"
    for k in range(3):  # one availableNow run per published slice, same checkpoint
        rep.feed(k)
        good, _ = parsed_bars(bar_stream(run.session, rep.source))
        q = run.start(stream_strategy(good, EmaCross(5, 30), 1000.0),
                      foreach_batch=accumulate(hist, run.run_id), available_now=True)
        q.awaitTermination(300)
        assert run.new_rows() > 0
    out = history(spark, hist, run.run_id)
    assert out.filter("late").count() == 0
    _compare(out.collect(), ema_crossover(bars, 1000.0, 5, 30).equity.collect(), ["fast", "slow", "sig", "equity"])


def test_stream_warmup_equals_run_range(spark):
    from barflow.plans.strategies import run_range, with_warmup

    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    start, end = "1997-01-01", "1997-12-31"
    window = with_warmup(bars, start, end, 30).select(*BAR_COLUMNS)
    run = Run(spark)
    rep = stage_replay(window, f"{run.folder}/replay", 3)
    hist = f"{run.folder}/history"
    rep.feed(0)
    good, _ = parsed_bars(bar_stream(run.session, rep.source))
    flagged = good.withColumn("warm", F.col("ts") < F.lit(start).cast("timestamp_ntz"))
    q = run.start(stream_strategy(flagged, SmaCross(5, 30), 1000.0, warmup_col="warm"),
                  foreach_batch=accumulate(hist, run.run_id))
    q.processAllAvailable()
    for k in (1, 2):
        rep.feed(k)
        q.processAllAvailable()
    run.stop()
    out = history(spark, hist, run.run_id)
    batch = run_range(bars, None, start, end, "sma", 1000.0, short_period=5, long_period=30)
    _compare(out.collect(), batch.equity.collect(), ["fast", "slow", "sig", "cash", "pos", "equity"])


def test_publish_bar_stream_roundtrip(spark):
    from barflow.streaming.publish import publish_bar_stream

    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    run = Run(spark)
    rep = stage_replay(bars, f"{run.folder}/replay", 2)
    rep.feed(0)
    rep.feed(1)
    good, _ = parsed_bars(bar_stream(run.session, rep.source))
    out = f"{run.folder}/published"
    q = publish_bar_stream(good, f"{run.folder}/pub-ckpt", out)
    q.processAllAvailable()
    q.stop()
    back, _ = parsed_bars(spark.read.text(out))
    assert back.exceptAll(bars).count() == 0 and bars.exceptAll(back).count() == 0


def test_new_run_stops_previous_and_starts_clean(spark):
    from barflow.streaming.control import new_run
    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    first = Run(spark)
    rep = stage_replay(bars, f"{first.folder}/replay", 1)
    rep.feed(0)
    good, _ = parsed_bars(bar_stream(first.session, rep.source))
    q = first.start(good, foreach_batch=accumulate(f"{first.folder}/history", first.run_id), interval_ms=200)
    q.processAllAvailable()
    second = new_run(spark, first)
    assert not q.isActive and first.query is None
    assert second.run_id != first.run_id and second.folder != first.folder


def test_stream_bars_append_mode_emits_closed_windows(spark):
    from barflow.operators.bars import ohlcv_bar_stream
    from barflow.sources.ticks import event_ticks
    from barflow.streaming.replay import stage_frame_replay

    ticks = event_ticks(spark, SF001)
    batch = {(r["symbol"], r["ts"]): tuple(r) for r in ohlcv_bars(ticks, "1 hour").collect()}
    run = Run(spark)
    rep = stage_frame_replay(ticks, f"{run.folder}/ticks", 3)
    hist = f"{run.folder}/history"
    rep.feed(0)
    q = run.start(ohlcv_bar_stream(rep.stream(run.session), "1 hour", "1 hour"), foreach_batch=accumulate(hist, run.run_id))
    q.processAllAvailable()
    for k in (1, 2):
        rep.feed(k)
        q.processAllAvailable()
    run.stop()
    got = history(spark, hist, run.run_id).drop("batch_id").collect()
    assert got and len(got) < len(batch)  # the windows still open at the end stay in state
    cols = ["symbol", "ts", "open", "high", "low", "close", "volume", "n_ticks"]
    keys = [(r["symbol"], r["ts"]) for r in got]
    assert len(keys) == len(set(keys))  # append mode: each bar once
    for r in got:
        assert tuple(r[c] for c in cols) == batch[(r["symbol"], r["ts"])]


def test_stream_halt_mode_equals_batch_and_trigger_clamp(spark):
    from barflow.streaming.control import trigger_options
    assert trigger_options(200, floor_ms=1000) == {"processingTime": "1000 milliseconds"}
    assert trigger_options(None) == {} and trigger_options(5, available_now=True) == {"availableNow": True}

    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    run = Run(spark)
    rep = stage_replay(bars, f"{run.folder}/replay", 2)
    hist = f"{run.folder}/history"
    rep.feed(0)
    good, _ = parsed_bars(bar_stream(run.session, rep.source))
    q = run.start(stream_strategy(good, SmaCross(5, 30), 1000.0, insolvency="halt"),
                  foreach_batch=accumulate(hist, run.run_id))
    q.processAllAvailable()
    rep.feed(1)
    q.processAllAvailable()
    run.stop()
    batch = sma_crossover(bars, 1000.0, 5, 30, insolvency="halt").equity
    _compare(history(spark, hist, run.run_id).collect(), batch.collect(), ["sig", "cash", "pos", "equity"])


def test_half_written_and_repeated_batches_are_not_seen(spark):
    run = Run(spark)
    hist = f"{run.folder}/history"
    write = accumulate(hist, run.run_id)
    frame = spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, ts int")
    assert history(spark, hist, run.run_id, frame.schema).count() == 0  # nothing yet
    write(frame, 0)
    write(frame.where("ts = 1"), 1)
    # A writer that was lost: its rows are there, but it was never entered.
    frame.write.parquet(f"{hist}/run_id={run.run_id}/batch_id=2/attempt=lost")
    got = history(spark, hist, run.run_id)
    assert sorted((r["symbol"], r["batch_id"]) for r in got.collect()) == [("A", 0), ("A", 1), ("B", 0)]
    write(frame.where("ts = 2"), 0)  # run again after a failure: the new attempt counts
    view = live_view(spark, hist, run.run_id, "finished", frame.schema)
    assert sorted((r["symbol"], r["batch_id"]) for r in spark.table("finished").collect()) == [("A", 1), ("B", 0)]
    assert view.columns == ["symbol", "ts", "batch_id"]
    assert sorted((r["batch_id"], r["n_rows"]) for r in batches(spark, hist, run.run_id).collect()) == [(0, 1), (1, 1)]
    assert [r["ts"] for r in snapshot(spark, hist, run.run_id).collect()] == [1, 2]


def test_replay_straight_from_the_stored_slices_after_a_restart(spark):
    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    run = Run(spark)
    rep = stage_replay(bars, f"{run.folder}/replay", 4)
    hist = f"{run.folder}/history"
    for k in (0, 1, 1, 2, 3):  # slice 1 is run again: its files are known, so nothing comes twice
        again = Run(spark, run.run_id)  # a new driver on the same checkpoint
        good, _ = parsed_bars(rep.slice_stream(k, again.session))
        again.drain(stream_strategy(good, EmaCross(5, 30), 1000.0), foreach_batch=accumulate(hist, run.run_id))
    out = history(spark, hist, run.run_id)
    assert out.filter("late").count() == 0
    _compare(out.collect(), ema_crossover(bars, 1000.0, 5, 30).equity.collect(), ["fast", "slow", "sig", "equity"])


def test_runs_do_not_change_the_callers_settings(spark):
    before = dict(spark.conf.getAll)
    run = Run(spark)
    run.session.conf.set("spark.sql.shuffle.partitions", "3")
    assert dict(spark.conf.getAll) == before and run.session is run.session


def test_quiet_slices_are_streams_without_rows(spark):
    import datetime as dt

    from conftest import make_bars

    early, late = make_bars(spark, [1.0, 2.0]), make_bars(spark, [3.0], start=dt.datetime(2030, 1, 1))
    run = Run(spark)
    rep = stage_replay(early.unionByName(late), f"{run.folder}/replay", 5)
    for k in range(5):
        run.drain(parsed_bars(rep.slice_stream(k, run.session))[0], foreach_batch=accumulate(f"{run.folder}/h", run.run_id))
    assert [r["close"] for r in snapshot(spark, f"{run.folder}/h", run.run_id).collect()] == [1.0, 2.0, 3.0]


def test_seen_spans_against_a_set():
    import random

    import numpy as np

    from barflow.operators.dedupe import merge_spans, unseen

    rnd = random.Random(4)
    for step in (0, 1, 3):
        los = his = np.empty(0, dtype=np.int64)
        seen = set()
        for _ in range(60):
            ts = np.array(sorted({rnd.randrange(0, 300) * max(step, 1) for _ in range(rnd.randint(0, 12))}), dtype=np.int64)
            fresh = unseen(los, his, ts)
            assert fresh.tolist() == [t not in seen for t in ts.tolist()]
            seen |= set(ts.tolist())
            los, his = merge_spans(los, his, ts[fresh], step)
            assert (los[1:] > his[:-1] + step).all() and (los <= his).all()
