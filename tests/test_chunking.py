"""Chunked evaluation equals a single pass over each symbol."""

import random

import pytest
from conftest import SF001, make_bars

from barflow.operators.bars import ohlcv_bars
from barflow.operators.indicators import rolling_means
from barflow.operators.sequence import ffill_last, with_seq
from barflow.plans.strategies import ema_crossover, rsi_strategy, sma_crossover
from barflow.sources.ticks import lineitem_ticks, order_ticks


def _by_key(df, cols):
    return {(r["symbol"], r["ts"]): tuple(r[c] for c in cols) for r in df.collect()}


def _close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tol * max(1.0, abs(a), abs(b))


def test_seq_is_dense_row_number(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    bars = ohlcv_bars(lineitem_ticks(spark, SF001))
    got = with_seq(bars, segment_seconds=7 * 86_400)
    want = bars.withColumn("rn", F.row_number().over(Window.partitionBy("symbol").orderBy("ts")) - 1)
    j = got.join(want, ["symbol", "ts"])
    assert j.filter("seq != rn").count() == 0
    assert j.count() == bars.count()


def test_sma_ema_rsi_equity_chunked(spark):
    bars = ohlcv_bars(lineitem_ticks(spark, SF001))
    for make, cols in [(lambda b, c: sma_crossover(b, 1000.0, 5, 30, chunk_rows=c), ["fast", "slow", "sig"]),
                       (lambda b, c: ema_crossover(b, 1000.0, 5, 30, chunk_rows=c), ["fast", "slow", "sig"])]:
        whole = _by_key(make(bars, 1_000_000).equity, cols + ["cash", "pos", "equity"])
        chunked = _by_key(make(bars, 97).equity, cols + ["cash", "pos", "equity"])
        assert whole.keys() == chunked.keys()
        for k in whole:
            assert all(_close(a, b) for a, b in zip(whole[k], chunked[k])), (k, whole[k], chunked[k])
    obars = ohlcv_bars(order_ticks(spark, SF001))
    whole = _by_key(rsi_strategy(obars, 100000.0, 5, chunk_rows=1_000_000).equity, ["rsi", "sig", "equity"])
    chunked = _by_key(rsi_strategy(obars, 100000.0, 5, chunk_rows=113).equity, ["rsi", "sig", "equity"])
    for k in whole:
        assert all(_close(a, b) for a, b in zip(whole[k], chunked[k])), (k, whole[k], chunked[k])


def test_ffill_last_across_chunks(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(7)
    closes = [float(rnd.randint(1, 50)) for _ in range(200)]
    bars = with_seq(make_bars(spark, closes))
    flagged = bars.withColumn("flag", (F.col("seq") % 37 == 5) | (F.col("seq") == 150)) \
                  .withColumn("v", F.col("seq") * 10)
    out = ffill_last(flagged, "flag", ["v"], chunk_rows=16).orderBy("seq").collect()
    last = None
    for r in out:
        if r["seq"] % 37 == 5 or r["seq"] == 150:
            last = r["seq"] * 10
        assert r["v"] == last, (r["seq"], r["v"], last)


def test_affine_scan_method_equals_halo(spark):
    from barflow.operators import indicators as ind
    bars = series_of(spark)
    halo = _by_key(ind.ema(bars, {"f": 5, "s": 30}), ["f", "s", "prev_f", "prev_s"])
    scan = _by_key(ind.ema(bars, {"f": 5, "s": 30}, method="scan", chunk_rows=101),
                   ["f", "s", "prev_f", "prev_s"])
    assert halo.keys() == scan.keys()
    for k in halo:
        assert all(_close(a, b, 1e-12) for a, b in zip(halo[k], scan[k])), (k, halo[k], scan[k])
    obars = with_seq(ohlcv_bars(order_ticks(spark, SF001)))
    h = _by_key(ind.rsi(obars, 5), ["avg_gain", "avg_loss", "rsi"])
    s = _by_key(ind.rsi(obars, 5, method="scan", chunk_rows=89), ["avg_gain", "avg_loss", "rsi"])
    for k in h:
        assert all(_close(a, b, 1e-12) for a, b in zip(h[k], s[k])), (k, h[k], s[k])


def series_of(spark):
    return with_seq(ohlcv_bars(lineitem_ticks(spark, SF001)))


def test_halo_method_across_many_chunks(spark):
    from barflow.operators import indicators as ind
    bars = series_of(spark)  # ~1,400 bars per symbol; span 2/3 halos are ~41/64 rows
    one = _by_key(ind.ema(bars, {"f": 2, "s": 3}, method="halo"), ["f", "s", "prev_f", "prev_s"])
    many = _by_key(ind.ema(bars, {"f": 2, "s": 3}, method="halo", chunk_rows=50), ["f", "s", "prev_f", "prev_s"])
    assert one.keys() == many.keys()
    for k in one:
        assert all(_close(a, b, 1e-12) for a, b in zip(one[k], many[k])), (k, one[k], many[k])
    obars = with_seq(ohlcv_bars(order_ticks(spark, SF001)))
    h1 = _by_key(ind.rsi(obars, 2, method="halo"), ["rsi", "prev_rsi"])
    h2 = _by_key(ind.rsi(obars, 2, method="halo", chunk_rows=60), ["rsi", "prev_rsi"])
    for k in h1:
        assert all(_close(a, b, 1e-12) for a, b in zip(h1[k], h2[k])), (k, h1[k], h2[k])


def test_rsi_many_equals_single_period(spark):
    from barflow.operators import indicators as ind
    obars = with_seq(ohlcv_bars(order_ticks(spark, SF001)))
    many = _by_key(ind.rsi_many(obars, [3, 5]), ["rsi_3", "prev_rsi_3", "rsi_5", "prev_rsi_5"])
    r3 = _by_key(ind.rsi(obars, 3), ["rsi", "prev_rsi"])
    r5 = _by_key(ind.rsi(obars, 5), ["rsi", "prev_rsi"])
    for k in many:
        assert all(_close(a, b, 1e-12) for a, b in zip(many[k], r3[k] + r5[k])), (k, many[k], r3[k], r5[k])


def test_auto_method_picks_scan_for_very_long_spans():
    from barflow.operators import indicators as ind
    from barflow.operators.recurrence import ewm_columns, ewm_scan_columns, halo_rows, span_alpha
    assert ind._ewm("auto", [span_alpha(30)], 250_000) is ewm_columns
    assert ind._ewm("auto", [span_alpha(100_000)], 250_000) is ewm_scan_columns
    assert halo_rows(span_alpha(30)) < 1000 and halo_rows(1.0) == 1


def test_over_chunks_invariants(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from pyspark.sql import functions as F
    from barflow.operators.sequence import CHUNK, HOME, effective_chunk_rows, home_rows, over_chunks

    @settings(max_examples=6, deadline=None)
    @given(n=st.integers(1, 300), chunk=st.integers(1, 80), halo=st.integers(0, 40))
    def check(n, chunk, halo):
        df = spark.range(n).select(F.lit("S").alias("symbol"), F.col("id").alias("seq"))
        ch = over_chunks(df, halo, chunk).collect()
        c = effective_chunk_rows(halo, chunk)
        homes = sorted(r["seq"] for r in ch if r[HOME])
        assert homes == list(range(n))  # every row once at home
        members = {}
        for r in ch:
            members.setdefault(r[CHUNK], set()).add(r["seq"])
        for k, rows in members.items():
            first_home = k * c
            if first_home < n:
                need = set(range(max(0, first_home - halo), first_home))
                assert need <= rows, (k, halo, c)
        assert home_rows(over_chunks(df, halo, chunk)).count() == n

    check()


def test_with_seq_property(spark):
    import datetime as dt
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=4, deadline=None)
    @given(gaps=st.lists(st.integers(1, 5000), min_size=1, max_size=120),
           seg=st.sampled_from([3600, 86_400, 7 * 86_400, 32 * 86_400]))
    def check(gaps, seg):
        t, rows = dt.datetime(2020, 1, 1), []
        for i, g in enumerate(gaps):
            t += dt.timedelta(minutes=g)
            rows.append(("AB"[i % 2], t, float(i)))
        df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, close double")
        got = {(r["symbol"], r["ts"]): r["seq"] for r in with_seq(df, segment_seconds=seg).collect()}
        for sym in "AB":
            ts_sorted = sorted(r[1] for r in rows if r[0] == sym)
            assert [got[(sym, x)] for x in ts_sorted] == list(range(len(ts_sorted)))

    check()


def test_ffill_last_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from pyspark.sql import functions as F

    @settings(max_examples=4, deadline=None)
    @given(flags=st.lists(st.booleans(), min_size=1, max_size=150), chunk=st.integers(1, 40))
    def check(flags, chunk):
        rows = [("S", i, bool(f), float(i) if f else None) for i, f in enumerate(flags)]
        df = spark.createDataFrame(rows, "symbol string, seq long, flag boolean, v double")
        out = {r["seq"]: r["v"] for r in ffill_last(df, "flag", ["v"], chunk_rows=chunk).collect()}
        last = None
        for i, f in enumerate(flags):
            if f:
                last = float(i)
            assert out[i] == last, (i, out[i], last)

    check()


def test_affine_maps_in_blocks_match_a_loop():
    import numpy as np

    from barflow.operators import recurrence as R

    rnd = np.random.default_rng(2)
    for n in (0, 1, 2, 511, 512, 513, 5000):
        a, b = rnd.uniform(0, 1, n), rnd.normal(size=n)
        a[rnd.uniform(size=n) < 0.02] = 0.0
        y, want = 3.0, []
        for x_a, x_b in zip(a.tolist(), b.tolist(), strict=True):
            y = x_a * y + x_b
            want.append(y)
        np.testing.assert_allclose(R.apply_maps(a, b, 3.0), want, rtol=1e-12, atol=1e-12)
        big_a, big_b = R.compose_maps(a, b)
        assert big_a * 3.0 + big_b == pytest.approx(want[-1] if n else 3.0, abs=1e-12)


def test_prefix_means_match_sliding_frames(spark):
    """Values far apart in size, missing ones and one that is not a number; the error is bound by the chunk's largest."""
    import math
    import random

    rnd = random.Random(6)
    closes = [rnd.choice([round(rnd.uniform(1, 500), 2), 10.1, 10.1, 7.0, rnd.uniform(0, 1e-6), 1e7]) for _ in range(700)]
    for i in (5, 80, 81, 300, 640):
        closes[i] = None
    closes[500] = float("nan")
    frame = with_seq(make_bars(spark, closes))
    periods = {"a": 1, "b": 2, "c": 7, "d": 60}
    for chunk_rows in (250, 100_000):
        rows = rolling_means(frame, periods, chunk_rows=chunk_rows).orderBy("seq").collect()
        for name, n in periods.items():
            for i, r in enumerate(rows):
                window = closes[max(0, i - n + 1):i + 1]
                if len(window) < n or None in window:
                    assert r[name] is None
                elif any(math.isnan(x) for x in window):
                    assert math.isnan(r[name])
                else:
                    assert r[name] == pytest.approx(math.fsum(window) / n, rel=1e-15, abs=1e-11)
                before, prev = rows[i - 1][name] if i else None, r[f"prev_{name}"]
                assert prev is None if before is None else math.isnan(before) and math.isnan(prev) or prev == pytest.approx(before, rel=1e-15, abs=1e-11)


def test_means_of_equal_prices_are_the_price(spark):
    """No rounding noise that could look like a crossing."""
    rows = rolling_means(with_seq(make_bars(spark, [10.1] * 3000)), {"fast": 5, "slow": 30}, chunk_rows=500).collect()
    assert {r["fast"] for r in rows if r["seq"] >= 4} | {r["slow"] for r in rows if r["seq"] >= 29} == {10.1}
