"""Tick frames built from the driver's tables.

A tick frame has ``symbol string, ts timestamp_ntz, px double, qty double, ord``
where ``ord`` totally orders the ticks of one symbol (first tick = open), and may have ``ord_key``, a
long that orders the ticks of a day in part (see ``operators.bars``).
These builders only map table columns onto that schema; all bar and strategy
work happens in the operators.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.columns import round_half_up, valid_price

_TWO_61 = 2 ** 61
_TWO_63 = 2 ** 63
_TWO_64 = 2 ** 64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pack_order(ts: str, ident: str) -> Column:
    """Order-preserving, injective DECIMAL(38,0) key for (ts, long id).

    (micros(ts) + 2^61) * 2^64 + (id + 2^63) stays below 2^126 < 10^38 for any
    timestamp within +-73,000 years. One fixed-width key keeps ``min_by`` /
    ``max_by`` in a map-side hash aggregate (a struct key would force a sort).
    """
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    def big(v: int):
        return F.lit(Decimal(v)).cast("decimal(38,0)")
    hi = micros.cast("decimal(38,0)") + big(_TWO_61)
    lo = F.col(ident).cast("decimal(38,0)") + big(_TWO_63)
    return (hi * big(_TWO_64) + lo).cast("decimal(38,0)")


def _valid(px: Column) -> Column:
    return valid_price(px) & F.col("symbol").isNotNull()


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame L: symbol l_returnflag, price per unit rounded to cents, ts l_shipdate.

    l_shipdate has no time of day and (l_orderkey, l_linenumber) repeats, so the
    tick order is the full row key; ``ord_key`` is its order as far as those two tell, where they fit.
    """
    li = read_table(spark, sf_dir, "lineitem")
    px = F.when(F.col("l_quantity") != 0, F.col("l_extendedprice") / F.col("l_quantity"))
    order, line = F.col("l_orderkey").cast("long"), F.col("l_linenumber").cast("long")
    fits = order.between(0, 2**39 - 1) & line.between(0, 15) & (F.date_trunc("day", "l_shipdate") == F.col("l_shipdate"))
    t = li.select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_shipdate").alias("ts"),
        round_half_up(px, 2).alias("px"),
        F.col("l_quantity").alias("qty"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                 "l_extendedprice", "l_quantity").alias("ord"),
        F.when(fits, order * 16 + line).alias("ord_key"),
    )
    return t.filter(F.col("ts").isNotNull() & _valid(F.col("px")))


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame E: symbol event_type, price value, one unit per event, order (ts, event_id)."""
    ev = read_table(spark, sf_dir, "events")
    t = ev.select(
        F.col("event_type").alias("symbol"),
        F.col("ts"),
        F.col("value").alias("px"),
        F.lit(1.0).alias("qty"),
        pack_order("ts", "event_id").alias("ord"),
    )
    return t.filter(F.col("ts").isNotNull() & _valid(F.col("px")))


def order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame O: symbol o_orderpriority, price o_totalprice, order (o_orderdate, o_orderkey)."""
    o = read_table(spark, sf_dir, "orders")
    t = o.select(
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("px"),
        F.lit(1.0).alias("qty"),
        pack_order("o_orderdate", "o_orderkey").alias("ord"),
    )
    return t.filter(F.col("ts").isNotNull() & _valid(F.col("px")))
