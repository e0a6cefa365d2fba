"""Wire decode cases (FIXTURES.md section 1) and the encode/decode round trip."""

import datetime as dt

from conftest import SF001, stored_plans

from barflow.operators.bars import ohlcv_bars
from barflow.schema import BAR_COLUMNS
from barflow.sources.codec import (decode_bars, encode_bars, normalise_ts, rename_bar_fields,
                                   split_quarantine)
from barflow.sources.scan import scan_bars
from barflow.sources.ticks import lineitem_ticks


def _decode(spark, msgs):
    raw = spark.createDataFrame([(m,) for m in msgs], "value string")
    return split_quarantine(normalise_ts(decode_bars(raw), default_symbol="S"))


def test_decode_cases(spark):
    good, bad = _decode(spark, [
        '{"symbol":"S","timestamp":1685592000123,"open":1,"high":2,"low":0.5,"close":1.5,"volume":54}',
        '{"symbol":"S","timestamp":1685592060123,"open":1,"high":2,"low":0.5,"close":1.5,"volume":5.4E7}',
        'garbage',
        '{"volume":1.5,"timestamp":1685592120123,"close":1.5}',
        '{"symbol":"S","timestamp":1685592180000,"close":0}',
    ])
    g = good.orderBy("ts").collect()
    assert g[0]["ts"] == dt.datetime(2023, 6, 1, 4, 0, 0) and g[0]["volume"] == 54
    assert g[1]["volume"] == 54_000_000
    assert g[2]["close"] == 1.5 and g[2]["open"] is None
    assert len(g) == 3
    assert bad.count() == 2  # garbage and the zero close


def test_keep_millis_option(spark):
    raw = spark.createDataFrame([('{"timestamp":1685592000123,"close":1}',)], "value string")
    r = normalise_ts(decode_bars(raw), keep_millis=True).collect()[0]
    assert r["ts"] == dt.datetime(2023, 6, 1, 4, 0, 0, 123000)


def test_roundtrip_and_rename(spark):
    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    back, _ = split_quarantine(normalise_ts(decode_bars(encode_bars(bars))))
    assert back.exceptAll(bars).count() == 0 and bars.exceptAll(back).count() == 0
    up = spark.createDataFrame([(1, 1.0, 2.0, 0.5, 1.5, 10)], "t long, o double, h double, l double, c double, v long")
    assert rename_bar_fields(up).columns == ["timestamp", "open", "high", "low", "close", "volume"]


def test_scan_range_is_pushed_down(spark, tmp_path):
    bars = ohlcv_bars(lineitem_ticks(spark, SF001)).select(*BAR_COLUMNS)
    path = str(tmp_path / "bars")
    bars.write.parquet(path)
    q = scan_bars(spark.read.parquet(path), "A", "1996-01-01", "1996-03-31", limit=10)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(symbol,A)" in plan
    rows = q.collect()
    assert len(rows) == 10 and [r["ts"] for r in rows] == sorted(r["ts"] for r in rows)


def test_symbol_from_key_or_default(spark):
    raw = spark.createDataFrame(
        [(b"AAA", b'{"timestamp":1685592000000,"close":2.0}'),
         (None, b'{"timestamp":1685592000000,"close":3.0}')], "key binary, value binary")
    good, bad = split_quarantine(normalise_ts(decode_bars(raw)))
    assert [r["symbol"] for r in good.collect()] == ["AAA"] and bad.count() == 1
    good, bad = split_quarantine(normalise_ts(decode_bars(raw), default_symbol="ONE"))
    assert sorted(r["symbol"] for r in good.collect()) == ["AAA", "ONE"] and bad.count() == 0


def test_scan_from_ticks_pushes_range_and_matches(spark):
    from barflow.sources.scan import scan_bars_from_ticks
    ticks = lineitem_ticks(spark, SF001)
    with stored_plans() as plans:
        q = scan_bars_from_ticks(ticks, "A", "1996-01-01", "1996-06-30")
    plan = plans[0][1]
    pushed = plan.split("PushedFilters: ")[1]  # Spark truncates long metadata strings
    assert "EqualTo(l_returnflag,A)" in pushed and "GreaterThanOrEqual(l_sh" in pushed
    full = scan_bars(ohlcv_bars(ticks), "A", "1996-01-01", "1996-06-30")
    assert q.exceptAll(full).count() == 0 and full.exceptAll(q).count() == 0
    hourly = scan_bars_from_ticks(ticks, "A", "1996-01-01", "1996-06-30", every="1 hour")
    assert hourly.count() == q.count()  # l_shipdate has no time of day


def test_nan_and_infinite_prices_are_quarantined(spark):
    raw = spark.createDataFrame(
        [('{"symbol":"S","timestamp":1685592000000,"close":NaN}',),
         ('{"symbol":"S","timestamp":1685592060000,"close":"Infinity"}',),
         ('{"symbol":"S","timestamp":1685592120000,"close":-1.0}',),
         ('{"symbol":"S","timestamp":1685592180000,"close":2.5}',)], "value string")
    good, bad = split_quarantine(normalise_ts(decode_bars(raw)))
    assert [r["close"] for r in good.collect()] == [2.5] and bad.count() == 3


def test_bar_table_prunes_partitions(spark, tmp_path):
    from barflow.sources.bar_table import read_bar_table, write_bar_table
    bars = ohlcv_bars(lineitem_ticks(spark, SF001))
    path = str(tmp_path / "bars")
    write_bar_table(bars, path)
    got = read_bar_table(spark, path, ["A"], "1996-02-01", "1996-02-29")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "year" in plan.split("PartitionFilters: ")[1]
    want = bars.filter("symbol = 'A' and ts >= '1996-02-01' and ts < '1996-03-01'").select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    write_bar_table(bars.filter("symbol = 'A'"), path)  # dynamic overwrite keeps other symbols
    assert read_bar_table(spark, path, ["N"]).count() == bars.filter("symbol = 'N'").count()


def test_scan_from_ticks_weekly_bars_fall_back_exactly(spark):
    from barflow.operators.bars import divides_day
    from barflow.sources.scan import scan_bars_from_ticks
    assert divides_day("1 day") and divides_day("15 minutes") and divides_day("1 hour")
    assert not divides_day("7 days") and not divides_day("7 minutes") and not divides_day("1 week")
    ticks = lineitem_ticks(spark, SF001)
    got = scan_bars_from_ticks(ticks, "N", "1996-01-01", "1996-06-30", every="7 days")
    want = scan_bars(ohlcv_bars(ticks, "7 days"), "N", "1996-01-01", "1996-06-30")
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
