"""Driver contract and plan shape."""

from conftest import SF001

import __spark_entry__ as E
from barflow.operators.bars import ohlcv_bars
from barflow.sources.ticks import event_ticks, lineitem_ticks


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and set(df.columns) >= {"symbol", "final_value"}


def test_every_query_has_oracle():
    """Every query of the strategy part; the optional part has some that SQL cannot express."""
    from barflow.plans import catalog
    assert set(catalog.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bar_scan_prunes_and_preaggregates(spark):
    plan = _plan(ohlcv_bars(event_ticks(spark, SF001), "1 hour"))
    assert "HashAggregate" in plan and "partial_min_by" in plan
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]  # unused column not read
    plan_l = _plan(ohlcv_bars(lineitem_ticks(spark, SF001)))
    assert "l_tax" not in plan_l and "l_discount" not in plan_l


def test_fold_partitioned_by_key(spark):
    from barflow.operators.ledger import run_ledger
    from barflow.plans.strategies import sma_crossover
    bt = sma_crossover(ohlcv_bars(lineitem_ticks(spark, SF001)), 1000.0, 5, 30)
    plan = _plan(run_ledger(bt.frame, 1000.0))
    assert "MapInPandas" in plan or "MapInArrow" in plan
    assert "hashpartitioning(symbol" in plan
