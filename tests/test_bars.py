"""S7 in two phases, and the bar index that turns a look-back into a range."""

import datetime as dt
import random
from functools import partial

import pytest
from conftest import SF001, make_bars, stored_plans
from pyspark.sql import functions as F

from barflow.operators.bars import divides_day, ohlcv_bars
from barflow.plans.strategies import read_warmup, run_range, run_stored_range, with_warmup
from barflow.sources.bar_index import bar_counts, lookback_start, read_bar_index, tick_bar_counts, write_bar_index
from barflow.sources.bar_table import read_bar_table, write_bar_table
from barflow.sources.scan import ticks_between
from barflow.sources.ticks import lineitem_ticks


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def made_ticks(spark, n=400):
    """Ticks of few keys: many equal ones with equal and with different prices, some without a key or with an odd price."""
    rnd = random.Random(8)
    rows = []
    for i in range(n):
        day, order = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randrange(40)), rnd.randrange(3)
        px = rnd.choice([1.0, 2.5, 2.5, 99.99, 10485.75, 20971.51, 1e7, 1e12, 0.001, 1 / 3])
        rows.append((rnd.choice(["A", "B", None]), day, px, float(rnd.randrange(1, 9)), (day, order, i), rnd.choice([order, order, order, None]) if i % 7 else order))
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, px double, qty double, ord struct<d:timestamp_ntz,o:int,i:int>, ord_key long")


@pytest.mark.parametrize("every", ["1 day", "6 hours", "3 days", "1 week"])
def test_two_phases_equal_the_full_order(spark, every):
    ticks = made_ticks(spark)
    want = ohlcv_bars(ticks.drop("ord_key"), every)
    assert same(ohlcv_bars(ticks, every), want) and want.count() > 10
    lineitem = lineitem_ticks(spark, SF001)
    assert same(ohlcv_bars(lineitem, every), ohlcv_bars(lineitem.drop("ord_key"), every))
    assert divides_day(every) == (every in ("1 day", "6 hours"))


def test_first_phase_does_not_sort_the_ticks(spark):
    with stored_plans() as plans:
        ohlcv_bars(lineitem_ticks(spark, SF001))
    assert "HashAggregate" in plans[0][1] and "SortAggregate" not in plans[0][1] and "Sort " not in plans[0][1]


def test_no_ticks(spark):
    ticks = made_ticks(spark).limit(0)
    assert ohlcv_bars(ticks).count() == 0 and ohlcv_bars(ticks, "1 week").columns == ohlcv_bars(ticks.drop("ord_key")).columns


def test_lookback_start_against_counting(spark):
    rnd = random.Random(3)
    days = {s: sorted(rnd.sample(range(900), 250)) for s in ("A", "B")} | {"C": [850, 860]}
    start0 = dt.datetime(2020, 1, 1)
    rows = [(s, start0 + dt.timedelta(days=d)) for s, v in days.items() for d in v]
    index = bar_counts(spark.createDataFrame(rows, "symbol string, ts timestamp_ntz")).cache()
    for _ in range(12):
        start = start0 + dt.timedelta(days=rnd.randrange(1, 900))
        n = rnd.choice([0, 1, 5, 30, 400])
        for symbols in (["A"], ["A", "B"], None):
            got = dt.datetime.fromisoformat(lookback_start(index, start.strftime("%Y-%m-%d"), n, symbols))
            for s in symbols or days:
                before = [x for x in days[s] if start0 + dt.timedelta(days=x) < start]
                read = [x for x in before if start0 + dt.timedelta(days=x) >= got]
                assert len(read) >= min(n, len(before)), (start, n, s, got)
            if symbols == ["A"] and n and len([x for x in days["A"] if start0 + dt.timedelta(days=x) < start]) > n + 70:
                assert (start - got).days < 900 * (n + 70) / 250  # not the whole history


def test_range_run_reads_the_range_alone(spark, tmp_path):
    bars = ohlcv_bars(lineitem_ticks(spark, SF001))
    want = run_range(bars, "A", "1997-01-01", "1997-12-31", "sma", 1000.0, short_period=5, long_period=30).final.collect()
    ticks = lineitem_ticks(spark, SF001)
    index = tick_bar_counts(ticks)
    assert same(index, bar_counts(bars))
    with stored_plans() as plans:
        got = run_stored_range(partial(ticks_between, ticks), index, "A", "1997-01-01", "1997-12-31", "sma", starting_cash=1000.0, short_period=5, long_period=30)
        assert got.final.collect() == want
    pushed = plans[0][1].split("PushedFilters: ")[1].split("]")[0]
    assert "l_shipdate" in pushed and "l_returnflag" in pushed
    write_bar_table(bars, str(tmp_path / "bars"))
    write_bar_index(index, str(tmp_path / "index"))
    read = partial(read_bar_table, spark, str(tmp_path / "bars"))
    stored = read_bar_index(spark, str(tmp_path / "index"))
    with stored_plans() as plans:
        got = run_stored_range(read, stored, "A", "1997-01-01", "1997-12-31", "sma", starting_cash=1000.0, short_period=5, long_period=30)
        assert got.final.collect() == want
    part = plans[0][1].split("PartitionFilters: ")[1].split("]")[0]
    assert "symbol" in part and "year" in part
    # Both dates bound what is stored: fewer bars than two months before the start to the end.
    n = read_warmup(read, stored, "1997-01-01", "1997-12-31", 30, ["A"]).count()
    assert n == with_warmup(bars.where("symbol = 'A'"), "1997-01-01", "1997-12-31", 30).count()


def test_index_of_later_years_replaces_those_years_only(spark, tmp_path):
    early, late = make_bars(spark, [1.0] * 40, start=dt.datetime(2023, 12, 1)), make_bars(spark, [1.0] * 3, start=dt.datetime(2024, 6, 1))
    path = str(tmp_path / "index")
    write_bar_index(bar_counts(early), path)
    write_bar_index(bar_counts(early.where("ts >= '2024-01-01'").unionByName(late)), path)
    got = {(r["month"].strftime("%Y-%m"), r["n"]) for r in read_bar_index(spark, path).collect()}
    assert got == {("2023-12", 31), ("2024-01", 9), ("2024-06", 3)}
