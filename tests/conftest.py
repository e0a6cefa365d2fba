import contextlib
import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="barflow-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("barflow-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@contextlib.contextmanager
def stored_plans():
    """(name, executed plan) of every table that is stored meanwhile."""
    from barflow import session

    session.PLAN_LOG = []
    try:
        yield session.PLAN_LOG
    finally:
        session.PLAN_LOG = None


def make_bars(spark, closes, symbol="X", start=dt.datetime(2024, 1, 1)):
    """One bar per day; open/high/low follow the close (only close matters)."""
    from barflow.schema import BAR_SCHEMA

    rows = [(symbol, start + dt.timedelta(days=i), *([None if c is None else float(c)] * 4), 1)
            for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, BAR_SCHEMA)


def rows_by_ts(df, cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("symbol", "ts").collect()]
