"""The Spark ledger fold against a plain Python loop (brute force)."""

import datetime as dt
import random

import numpy as np
import pytest

from barflow.operators.ledger import lockstep, run_ledger


def brute(sigs, prices, cash, halt):
    pos = 0
    out = []
    for s, p in zip(sigs, prices):
        if s == 0:
            continue
        if pos * s < 0:
            cash += pos * p
            pos = 0
        if pos == 0 and not (halt and cash <= 0):
            n = int(cash / p)
            pos = n if s > 0 else -n
            cash = cash - n * p if s > 0 else cash + n * p
        out.append((cash, pos))
    return out


@pytest.mark.parametrize("halt", [False, True])
def test_fold_matches_loop(spark, halt):
    rnd = random.Random(11 + halt)
    rows, expect = [], {}
    for sym in ["A", "B", "C"]:
        sigs = [rnd.choice([-1, 0, 0, 1]) for _ in range(300)]
        prices = [round(rnd.uniform(1, 300), 2) for _ in range(300)]
        t0 = dt.datetime(2020, 1, 1)
        rows += [(sym, i, t0 + dt.timedelta(days=i), s, p) for i, (s, p) in enumerate(zip(sigs, prices))]
        expect[sym] = brute(sigs, prices, 1000.0, halt)
    frame = spark.createDataFrame(rows, "symbol string, seq long, ts timestamp_ntz, sig int, close double")
    frame = frame.repartition(5)  # arbitrary input order
    got = run_ledger(frame, 1000.0, insolvency="halt" if halt else "reference")
    for sym in expect:
        rs = [(r["cash"], r["pos"]) for r in got.filter(got.symbol == sym).orderBy("seq").collect()]
        assert rs == expect[sym]


@pytest.mark.parametrize("halt", [False, True])
def test_lanes_in_lockstep_match_single_lanes(halt):
    """Lanes of very different lengths, interleaved, over several batches."""
    rnd = random.Random(5 + halt)
    lanes = {k: [(rnd.choice([-1, 1]), round(rnd.uniform(1, 1500), 2)) for _ in range(rnd.choice([0, 1, 7, 200]))] for k in range(40)}
    expect = {k: brute([s for s, _ in v], [p for _, p in v], 1000.0, halt) for k, v in lanes.items()}
    rows = [(k, *x) for k, v in lanes.items() for x in v]
    order = sorted(range(len(rows)), key=lambda i: rnd.random())
    left = {k: iter(v) for k, v in lanes.items()}
    rows = [(rows[i][0], *next(left[rows[i][0]])) for i in order]  # lanes mixed, each in its own order
    cash, pos, got = np.full(40, 1000.0), np.zeros(40), {k: [] for k in lanes}
    at = 0
    while at < len(rows):
        part = rows[at:at + rnd.randint(1, 90)]
        at += len(part)
        after = lockstep(cash, pos, *(np.array(c) for c in zip(*part, strict=True)), halt)
        for (k, *_), c, p in zip(part, after[0].tolist(), after[1].tolist(), strict=True):
            got[k].append((c, p))
    assert got == expect
    assert [a.tolist() for a in lockstep(cash, pos, *(np.empty(0, dtype=np.int64) for _ in range(3)), halt)] == [[], [], [], []]


def test_null_and_many_key_columns(spark):
    rows = [(None, 1, 0, 1, 10.0), ("A", 1, 0, 1, 20.0), (None, 1, 1, -1, 11.0), ("A", 2, 0, -1, 30.0), ("A", 1, 1, -1, 25.0)]
    frame = spark.createDataFrame(rows, "symbol string, param int, seq long, sig int, close double").selectExpr("*", "timestamp_ntz'2020-01-01' AS ts")
    got = {(r["symbol"], r["param"], r["seq"]): (r["cash"], r["pos"]) for r in run_ledger(frame, 100.0, ["symbol", "param"]).collect()}
    for key in {r[:2] for r in rows}:
        mine = sorted(r for r in rows if r[:2] == key)
        want = brute([r[3] for r in mine], [r[4] for r in mine], 100.0, False)
        assert [got[(*key, r[2])] for r in mine] == want


def test_positions_that_are_not_exact_are_an_error():
    with pytest.raises(OverflowError):
        lockstep(np.array([1e20]), np.array([0.0]), np.array([0]), np.array([1]), np.array([0.01]))
