"""Golden micro-fixtures (FIXTURES.md section 3): every intermediate column."""

import math

import pytest
from conftest import make_bars, rows_by_ts

from barflow.operators import indicators as ind
from barflow.operators.dedupe import dedupe_bars
from barflow.operators.sequence import with_seq
from barflow.plans.strategies import ema_crossover, rsi_strategy, run_strategy, sma_crossover

CLOSES = [10, 11, 12, 11, 9, 8, 9, 11, 13, 12, 10, 9]


def approx_list(got, want, tol=1e-6):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        if w is None:
            assert g is None or (isinstance(g, float) and math.isnan(g)), (got, want)
        else:
            assert g is not None and abs(g - w) <= tol, (got, want)


def test_sma_2_4(spark):
    bt = sma_crossover(make_bars(spark, [float(c) for c in CLOSES]), 100.0, 2, 4)
    eq = rows_by_ts(bt.equity, ["fast", "slow", "sig", "cash", "pos", "equity"])
    approx_list([r[0] for r in eq], [None, 10.5, 11.5, 11.5, 10.0, 8.5, 8.5, 10.0, 12.0, 12.5, 11.0, 9.5])
    approx_list([r[1] for r in eq], [None, None, None, 11.0, 10.75, 10.0, 9.25, 9.25, 10.25, 11.25, 11.5, 11.0])
    assert [r[2] for r in eq] == [0, 0, 0, 0, -1, 0, 0, 1, 0, 0, -1, 0]
    approx_list([r[3] for r in eq], [100, 100, 100, 100, 199, 199, 199, 1, 1, 1, 141, 141])
    assert [r[4] for r in eq] == [0, 0, 0, 0, -11, -11, -11, 7, 7, 7, -7, -7]
    approx_list([r[5] for r in eq], [100, 100, 100, 100, 100, 111, 100, 78, 92, 85, 71, 78])
    fin = bt.final.collect()[0]
    assert abs(fin["final_value"] - 78) < 1e-9 and fin["n_signals"] == 3 and fin["n_opened"] == 3


def test_ema_2_4(spark):
    bt = ema_crossover(make_bars(spark, [float(c) for c in CLOSES]), 100.0, 2, 4)
    eq = rows_by_ts(bt.equity, ["fast", "slow", "sig", "cash", "pos", "equity"])
    approx_list([r[0] for r in eq], [10.0, 10.666667, 11.555556, 11.185185, 9.728395, 8.576132, 8.858711,
                                     10.286237, 12.095412, 12.031804, 10.677268, 9.559089])
    approx_list([r[1] for r in eq], [10.0, 10.4, 11.04, 11.024, 10.2144, 9.32864, 9.197184, 9.91831,
                                     11.150986, 11.490592, 10.894355, 10.136613])
    assert [r[2] for r in eq] == [0, 1, 0, 0, -1, 0, 0, 1, 0, 0, -1, 0]
    approx_list([r[3] for r in eq], [100, 1, 1, 1, 163, 163, 163, 9, 9, 9, 109, 109])
    assert [r[4] for r in eq] == [0, 9, 9, 9, -9, -9, -9, 5, 5, 5, -5, -5]
    approx_list([r[5] for r in eq], [100, 100, 109, 100, 82, 91, 82, 64, 74, 69, 59, 64])


def test_ema_gap_rule(spark):
    from pyspark.sql import functions as F
    bars = make_bars(spark, [1.0, 2.0, 3.0, 4.0, 5.0])
    bars = bars.withColumn("close", F.when(F.col("ts").isin("2024-01-02", "2024-01-03"), None)
                           .otherwise(F.col("close")))
    out = ind.ema(with_seq(bars), {"e": 3}, with_prev=False)
    approx_list([r[0] for r in rows_by_ts(out, ["e"])], [1.0, 1.0, 1.0, 3.4, 4.2])


def test_rsi_3_documented_seed(spark):
    closes = [20, 18, 16, 15, 14, 16, 18, 20, 22, 21, 19, 17]
    bt = rsi_strategy(make_bars(spark, [float(c) for c in closes]), 100.0, 3)
    eq = rows_by_ts(bt.equity, ["avg_gain", "avg_loss", "rsi", "sig", "cash", "pos", "equity"])
    approx_list([r[0] for r in eq], [None, None, None, 0.0, 0.0, 0.666667, 1.111111, 1.407407, 1.604938,
                                     1.069959, 0.713306, 0.475537])
    approx_list([r[1] for r in eq], [None, None, None, 1.666667, 1.444444, 0.962963, 0.641975, 0.427984,
                                     0.285322, 0.523548, 1.015699, 1.343799])
    approx_list([r[2] for r in eq], [None, None, None, 0.0, 0.0, 40.909091, 63.380282, 76.681614, 84.90566,
                                     67.144907, 41.255289, 26.13795])
    assert [r[3] for r in eq] == [0, 0, 0, 0, 0, 1, 0, 0, 0, -1, 0, 0]
    approx_list([r[4] for r in eq], [100] * 5 + [4] * 4 + [256] * 3)
    assert [r[5] for r in eq] == [0] * 5 + [6] * 4 + [-6] * 3
    approx_list([r[6] for r in eq], [100, 100, 100, 100, 100, 100, 112, 124, 136, 130, 142, 154])


@pytest.mark.parametrize("closes,want", [([5.0] * 8, [None] * 8),
                                         ([1.0, 2, 3, 4, 5, 6], [None, None, None, 100.0, 100.0, 100.0]),
                                         ([6.0, 5, 4, 3, 2, 1], [None, None, None, 0.0, 0.0, 0.0])])
def test_rsi_edges(spark, closes, want):
    out = ind.rsi(with_seq(make_bars(spark, closes)), 3)
    approx_list([r[0] for r in rows_by_ts(out, ["rsi"])], want)


def test_insolvency_reference_and_halt(spark):
    closes = [10.0, 11, 12, 10, 30, 20, 25]
    bt = sma_crossover(make_bars(spark, closes), 100.0, 1, 2)
    eq = rows_by_ts(bt.equity, ["sig", "cash", "pos", "equity"])
    assert [r[0] for r in eq] == [0, 0, 0, -1, 1, -1, 1]
    approx_list([r[1] for r in eq], [100, 100, 100, 200, -10, -10, -10])
    assert [r[2] for r in eq] == [0, 0, 0, -10, -3, -3, -3]
    approx_list([r[3] for r in eq], [100, 100, 100, 100, -100, -70, -85])
    halt = sma_crossover(make_bars(spark, closes), 100.0, 1, 2, insolvency="halt")
    eq = rows_by_ts(halt.equity, ["cash", "pos"])
    assert eq[4] == (-100.0, 0) and eq[-1] == (-100.0, 0)


def test_single_bar_equal_periods_and_price_above_cash(spark):
    one = sma_crossover(make_bars(spark, [10.0]), 100.0, 2, 4).final.collect()[0]
    assert one["final_value"] == 100.0 and one["n_signals"] == 0
    same = sma_crossover(make_bars(spark, [float(c) for c in CLOSES]), 100.0, 3, 3).final.collect()[0]
    assert same["n_signals"] == 0 and same["final_value"] == 100.0
    rich = sma_crossover(make_bars(spark, [c * 100.0 for c in CLOSES]), 100.0, 2, 4)
    fin = rich.final.collect()[0]
    assert fin["n_signals"] == 3 and fin["n_opened"] == 0 and fin["final_value"] == 100.0


def test_symbols_independent_and_order_irrelevant(spark):
    a = make_bars(spark, [float(c) for c in CLOSES], "A")
    b = make_bars(spark, [float(c) * 2 for c in reversed(CLOSES)], "B")
    both = a.unionByName(b).orderBy("close")  # input row order must not matter
    together = {r["symbol"]: r["final_value"] for r in sma_crossover(both, 100.0, 2, 4).final.collect()}
    alone_a = sma_crossover(a, 100.0, 2, 4).final.collect()[0]["final_value"]
    alone_b = sma_crossover(b, 100.0, 2, 4).final.collect()[0]["final_value"]
    assert together == {"A": alone_a, "B": alone_b}


def test_duplicates_and_empty(spark):
    bars = make_bars(spark, [float(c) for c in CLOSES])
    dup = dedupe_bars(bars.unionByName(bars))
    assert dup.count() == len(CLOSES)
    empty = bars.limit(0)
    assert sma_crossover(empty, 100.0, 2, 4).final.count() == 0
    assert sma_crossover(empty, 100.0, 2, 4).equity.count() == 0


def test_run_strategy_dispatch_and_validation(spark):
    bars = make_bars(spark, [float(c) for c in CLOSES])
    assert run_strategy("sma", bars, starting_cash=100.0, short_period=2, long_period=4).name == "sma"
    with pytest.raises(ValueError):
        run_strategy("macd", bars)
    with pytest.raises(ValueError):
        run_strategy("sma", bars, short_period=0, long_period=4)


def test_sma_operator_alone(spark):
    out = ind.sma(with_seq(make_bars(spark, [float(c) for c in CLOSES])), 4, out="s4")
    approx_list([r[0] for r in rows_by_ts(out, ["s4"])],
                [None, None, None, 11.0, 10.75, 10.0, 9.25, 9.25, 10.25, 11.25, 11.5, 11.0])


def test_ema_scan_method_null_rule(spark):
    from pyspark.sql import functions as F
    bars = make_bars(spark, [9.0, 1.0, 2.0, 3.0, 4.0, 5.0])
    bars = bars.withColumn("close", F.when(F.col("ts").isin("2024-01-01", "2024-01-03", "2024-01-04"), None)
                           .otherwise(F.col("close")))
    out = ind.ema(with_seq(bars), {"e": 3}, with_prev=False, method="scan")
    # leading NULL stays NULL; NULLs repeat the last value; after two of them the carried value weighs 1/8 against 1/2
    approx_list([r[0] for r in rows_by_ts(out, ["e"])], [None, 1.0, 1.0, 1.0, 3.4, 4.2])
    for method, chunk in (("halo", 250_000), ("auto", 250_000), ("auto", 2), ("scan", 2)):
        same = ind.ema(with_seq(bars), {"e": 3}, with_prev=False, method=method, chunk_rows=chunk)
        approx_list([r[0] for r in rows_by_ts(same, ["e"])], [None, 1.0, 1.0, 1.0, 3.4, 4.2])
    from barflow.streaming.protocol import EmaCross
    strategy = EmaCross(3, 3)
    state, got = strategy.init_state(), []
    for x in (float("nan"), 1.0, float("nan"), float("nan"), 4.0, 5.0):
        state, row = strategy.next(state, x)
        got.append(row["fast"])
    approx_list(got[1:], [1.0, 1.0, 1.0, 3.4, 4.2])


def test_ema_gap_longer_than_halo_over_a_chunk_start(spark):
    import numpy as np
    import pandas as pd
    from pyspark.sql import functions as F
    x = [float(10 + (i * 7) % 13) for i in range(500)]
    bars = with_seq(make_bars(spark, x))
    bars = bars.withColumn("close", F.when(F.col("seq").between(280, 419) | (F.col("seq") % 7 == 3), None).otherwise(F.col("close")))
    want = pd.Series([None if 280 <= i <= 419 or i % 7 == 3 else v for i, v in enumerate(x)], dtype=float)
    want = want.ewm(span=3, adjust=False).mean()
    got = rows_by_ts(ind.ema(bars, {"e": 3}, with_prev=False, chunk_rows=360), ["e"])
    assert np.allclose([r[0] for r in got], want, rtol=1e-12)
