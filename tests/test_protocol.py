"""A strategy's blocks equal its single steps, and chunks equal whole series."""

import math
import random

import numpy as np
import pytest
from conftest import SF001, make_bars

from barflow.operators.bars import ohlcv_bars
from barflow.plans.custom import run_bar_strategy, strategy_frame
from barflow.plans.strategies import sma_crossover
from barflow.sources.ticks import lineitem_ticks
from barflow.streaming.protocol import EmaCross, RsiThreshold, SmaCross, run_block


def closes_of(rnd, n, missing):
    out, x = [], 100.0
    for _ in range(n):
        x = max(1.0, x + rnd.choice([-3, -1, 0, 0, 1, 2.5]))
        out.append(float("nan") if rnd.random() < missing else x)
    return out


def same(a, b):
    return (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b, rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("missing", [0.0, 0.15])
@pytest.mark.parametrize("strategy", [SmaCross(2, 5), SmaCross(7, 3), SmaCross(1, 1), EmaCross(2, 6), RsiThreshold(3), RsiThreshold(1)], ids=lambda s: s.name)
def test_blocks_equal_single_steps(strategy, missing):
    rnd = random.Random(3)
    closes = closes_of(rnd, 400, missing)
    if missing and strategy.name == "rsi":
        closes[:8] = [50.0 + i % 3 for i in range(8)]  # a seed of values
    state, rows = strategy.init_state(), []
    for c in closes:
        state, row = strategy.next(state, c)
        rows.append(row)
    for _ in range(5):
        block, at = strategy.init_state(), 0
        while at < len(closes):
            size = rnd.choice([1, 2, 3, 50, 400])
            part = np.array(closes[at:at + size])
            block, columns, sig = run_block(strategy, block, part)
            for i in range(len(part)):
                want = rows[at + i]
                assert all(same(float("nan") if want[c] is None else want[c], columns[c][i]) for c in strategy.columns), (at + i)
                assert sig[i] == want["sig"]
            at += size
        assert len(block) == len(state) and all(same(x, y) for x, y in zip(block, state, strict=True))


def stubborn():
    """Made in a function, so that it is shipped to the workers with the task."""

    class Stubborn:
        """A user's strategy without ``block``: buys when the close is a new high, sells when it is a new low."""

        name, columns, fixed = "stubborn", ("top", "bottom"), 2

        def init_state(self):
            return [float("-inf"), float("inf")]

        def next(self, state, close):
            top, bottom = state
            sig = 1 if close > top else -1 if close < bottom else 0
            return [max(top, close), min(bottom, close)], {"top": max(top, close), "bottom": min(bottom, close), "sig": sig}

    return Stubborn


def test_strategy_without_a_block_or_lookback(spark):
    bars = ohlcv_bars(lineitem_ticks(spark, SF001))
    rows = run_bar_strategy(bars, stubborn()(), 1000.0).orderBy("symbol", "seq").collect()
    strategy, state = stubborn()(), None
    for r in rows:
        state = strategy.init_state() if r["seq"] == 0 else state
        state, want = strategy.next(state, r["close"])
        assert (r["top"], r["bottom"], r["sig"]) == (want["top"], want["bottom"], want["sig"])
        assert r["equity"] == pytest.approx(r["cash"] + r["pos"] * r["close"])


def test_chunked_strategy_uses_a_task_a_chunk_and_equals_the_built_in(spark):
    bars = ohlcv_bars(lineitem_ticks(spark, SF001))
    want = {(r["symbol"], r["ts"]): r for r in sma_crossover(bars, 1000.0, 5, 30).equity.collect()}
    got = run_bar_strategy(bars, SmaCross(5, 30), 1000.0, chunk_rows=150).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[(r["symbol"], r["ts"])]
        assert (r["sig"], r["pos"]) == (w["sig"], w["pos"]) and r["equity"] == pytest.approx(w["equity"])
    frame = strategy_frame(bars, SmaCross(5, 30), chunk_rows=150)
    assert "hashpartitioning(symbol" in frame._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in frame._jdf.queryExecution().executedPlan().toString().split("hashpartitioning(symbol")[1][:40]


def test_sequential_strategy_resets_at_each_key(spark):
    bars = make_bars(spark, [10.0, 11.0, 9.0, 12.0, 8.0, 13.0], "A").unionByName(make_bars(spark, [5.0, 6.0, 4.0, 7.0], "B"))
    rows = run_bar_strategy(bars, RsiThreshold(2), 100.0, insolvency="halt").orderBy("symbol", "seq").collect()
    assert [r["seq"] for r in rows] == [0, 1, 2, 3, 4, 5, 0, 1, 2, 3]
    assert all(r["rsi"] is None for r in rows if r["seq"] < 2) and rows[6]["cash"] == 100.0
