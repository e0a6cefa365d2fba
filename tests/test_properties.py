"""Properties from SURVEY section 5: prefix law, final value = last equity row."""

import random

import pytest
from conftest import make_bars

from barflow.plans.strategies import ema_crossover, rsi_strategy, sma_crossover


def _walk(n, seed):
    rnd = random.Random(seed)
    x, out = 50.0, []
    for _ in range(n):
        x = max(1.0, round(x + rnd.uniform(-3, 3), 2))
        out.append(x)
    return out


@pytest.mark.parametrize("make", [
    lambda b: sma_crossover(b, 500.0, 3, 8),
    lambda b: ema_crossover(b, 500.0, 3, 8),
    lambda b: rsi_strategy(b, 500.0, 4),
])
def test_prefix_law_and_final_is_last_equity(spark, make):
    closes = _walk(80, 3)
    full = make(make_bars(spark, closes))
    eq = [r["equity"] for r in full.equity.orderBy("ts").collect()]
    final = full.final.collect()[0]["final_value"]
    assert abs(final - eq[-1]) < 1e-9
    for k in (10, 37, 61):  # strategies only look backward: a prefix run ends at row k-1 of the full run
        pre = make(make_bars(spark, closes[:k])).final.collect()[0]["final_value"]
        assert abs(pre - eq[k - 1]) < 1e-9, (k, pre, eq[k - 1])


def test_bar_strategy_batch_runner_equals_builtin(spark):
    from barflow.plans.custom import run_bar_strategy
    from barflow.streaming.protocol import EmaCross, RsiThreshold, SmaCross
    a = make_bars(spark, _walk(90, 5), "A")
    b = make_bars(spark, _walk(70, 9), "B")
    bars = a.unionByName(b)
    for strat, builtin, cols in [(SmaCross(3, 8), sma_crossover(bars, 500.0, 3, 8), ["fast", "slow"]),
                                 (EmaCross(3, 8), ema_crossover(bars, 500.0, 3, 8), ["fast", "slow"]),
                                 (RsiThreshold(4), rsi_strategy(bars, 500.0, 4), ["rsi"])]:
        got = {(r["symbol"], r["ts"]): r for r in run_bar_strategy(bars, strat, 500.0).collect()}
        want = {(r["symbol"], r["ts"]): r for r in builtin.equity.collect()}
        assert got.keys() == want.keys()
        for k, w in want.items():
            g = got[k]
            assert g["sig"] == w["sig"] and g["pos"] == w["pos"]
            for c in cols + ["equity"]:
                assert (g[c] is None and w[c] is None) or abs(g[c] - w[c]) < 1e-9, (k, c, g[c], w[c])


def test_run_range_warmup_matches_full_history(spark):
    import datetime as dt
    from barflow.plans.strategies import run_range
    bars = make_bars(spark, _walk(120, 21), "A").unionByName(make_bars(spark, _walk(120, 4), "B"))
    start, end = dt.datetime(2024, 2, 20), dt.datetime(2024, 4, 10)
    bt = run_range(bars, "A", "2024-02-20", "2024-04-10", "sma", 500.0, short_period=3, long_period=8)
    ranged = {r["ts"]: (r["fast"], r["slow"], r["sig"]) for r in bt.frame.collect()}
    full = {r["ts"]: (r["fast"], r["slow"], r["sig"])
            for r in sma_crossover(bars.filter("symbol = 'A'"), 500.0, 3, 8).frame.collect()
            if start <= r["ts"] <= end}
    assert ranged.keys() == full.keys() and min(ranged) == start
    for ts, (f, s, sig) in full.items():
        assert abs(ranged[ts][0] - f) < 1e-12 and abs(ranged[ts][1] - s) < 1e-12 and ranged[ts][2] == sig
    trades = bt.trades.collect()
    assert trades and all(start <= t["ts"] <= end for t in trades)
    assert bt.final.collect()[0]["symbol"] == "A"


def test_sweep_all_equals_individual_sweeps(spark):
    from barflow.plans.sweep import sweep_all, sweep_ema, sweep_rsi, sweep_sma
    bars = make_bars(spark, _walk(100, 8), "A").unionByName(make_bars(spark, _walk(100, 13), "B"))
    pairs, periods = [(3, 8), (5, 12)], [3, 6]
    allf = {(r["symbol"], r["strategy"], r["param_a"], r["param_b"]): r["final_value"]
            for r in sweep_all(bars, pairs, pairs, periods, 500.0).final.collect()}
    want = {}
    for name, bt in (("sma", sweep_sma(bars, pairs, 500.0)), ("ema", sweep_ema(bars, pairs, 500.0))):
        for r in bt.final.collect():
            want[(r["symbol"], name, r["fast_period"], r["slow_period"])] = r["final_value"]
    for r in sweep_rsi(bars, periods, 500.0).final.collect():
        want[(r["symbol"], "rsi", r["rsi_period"], 0)] = r["final_value"]
    assert allf.keys() == want.keys()
    assert all(abs(allf[k] - want[k]) < 1e-9 for k in want)


def test_null_key_values_form_their_own_series(spark):
    from pyspark.sql import functions as F
    a = make_bars(spark, _walk(80, 31), "A").withColumn("grp", F.lit(None).cast("string"))
    b = make_bars(spark, _walk(80, 32), "A").withColumn("grp", F.lit("x"))
    both = a.unionByName(b)
    for make in (lambda d, k: sma_crossover(d, 500.0, 3, 8, keys=k), lambda d, k: ema_crossover(d, 500.0, 3, 8, keys=k),
                 lambda d, k: rsi_strategy(d, 500.0, 4, keys=k)):
        got = {r["grp"]: r["final_value"] for r in make(both, ("symbol", "grp")).final.collect()}
        alone_a = make(a.drop("grp"), ("symbol",)).final.collect()[0]["final_value"]
        alone_b = make(b.drop("grp"), ("symbol",)).final.collect()[0]["final_value"]
        assert got == {None: alone_a, "x": alone_b}
        eq = make(both, ("symbol", "grp")).equity
        assert eq.filter(F.col("grp").isNull()).count() == 80 and eq.count() == 160


def test_run_range_without_warmup_equals_cut_series(spark):
    from barflow.plans.strategies import run_range
    bars = make_bars(spark, _walk(120, 41), "A")
    bt = run_range(bars, "A", "2024-02-20", "2024-04-10", "ema", 500.0, warmup=False,
                        short_period=3, long_period=8)
    cut = bars.filter("ts >= '2024-02-20' and ts < '2024-04-11'")
    want = ema_crossover(cut, 500.0, 3, 8).final.collect()[0]
    got = bt.final.collect()[0]
    assert got["n_bars"] == want["n_bars"] == 51
    assert got["n_signals"] == want["n_signals"] and abs(got["final_value"] - want["final_value"]) < 1e-9
