"""OHLCV bars from ticks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.functions.columns import event_time, wall_clock
from barflow.session import materialize


# Bits beside a tick's coarse key that hold half of its price in cents; the largest upper half stands for a price that does not fit.
PRICE_BITS = 20
NO_PRICE = (1 << PRICE_BITS) - 1


def ohlcv_bars(ticks: DataFrame, every: str = "1 day", key: str = "symbol") -> DataFrame:
    """Tumbling-window bars per symbol.

    open/close are the prices of the first/last tick by ``ord``; high/low the
    extremes; volume the summed quantity. Every aggregate is decomposable, so
    Spark pre-aggregates inside each map task and the shuffle carries at most
    one partial row per (symbol, bucket, task): a symbol holding a third of all
    ticks costs no more shuffle than any other.

    Ticks whose order needs several columns may carry ``ord_key`` (see ``_keyed_bars``).
    """
    if "ord_key" in ticks.columns:
        return _keyed_bars(ticks.withColumnRenamed(key, "symbol"), every)
    bucket = F.window("ts", every).start
    # Bucket first: when the order key forces a sort-based aggregate, the sort
    # prefix is then the timestamp (radix-sortable) instead of the symbol string.
    return (
        ticks.groupBy(bucket.alias("ts"), F.col(key).alias("symbol"))
        .agg(
            F.min_by("px", "ord").alias("open"),
            F.max("px").alias("high"),
            F.min("px").alias("low"),
            F.max_by("px", "ord").alias("close"),
            F.sum("qty").cast("long").alias("volume"),
            F.count(F.lit(1)).alias("n_ticks"),
        )
        .select("symbol", "ts", "open", "high", "low", "close", "volume", "n_ticks")
    )


def _keyed_bars(ticks: DataFrame, every: str) -> DataFrame:
    """Bars in two phases, for ticks at midnight with a coarse order key.

    ``ord_key`` (below 2^43, or NULL) orders the ticks of a day as ``ord`` does as far as it tells them apart. Phase one
    is a hash aggregate on longs: the key with half of the price (in cents) in one number, whose least and greatest values give the first and
    last tick with its price; the same with the half's complement tells whether another price has the same key.
    Phase two reads again only the ticks of bars that phase one cannot decide (equal keys with different prices, no key, a price
    that does not fit) and takes the first and last of them by the full ``ord``. Phase one's bars are
    stored, as phase two is skipped if they are all decided.
    """
    bucket = (F.window("ts", every) if divides_day(every) else F.window("ts", "1 day")).start
    cents = F.rint(F.col("px") * 100)
    fits = (cents >= 0) & (cents < float(NO_PRICE << PRICE_BITS)) & (cents / 100 == F.col("px"))
    whole = cents.cast("long")
    halves = {"low": F.when(fits, whole.bitwiseAND(NO_PRICE)), "up": F.when(fits, F.shiftright(whole, PRICE_BITS))}
    ends = []
    for name, half in halves.items():
        slot = F.coalesce(half, F.lit(NO_PRICE).cast("long"))
        key, other = (F.shiftleft("ord_key", PRICE_BITS) + x for x in (slot, F.lit(NO_PRICE) - slot))
        ends += [F.min(key).alias(f"_first_{name}"), F.min(other).alias(f"_first_{name}_not"), F.max(key).alias(f"_last_{name}"), F.max(other).alias(f"_last_{name}_not")]
    first = materialize(ticks.groupBy(bucket.alias("ts"), "symbol").agg(
        *ends, (F.count("ord_key") == F.count(F.lit(1))).alias("_keyed"), F.max("px").alias("high"), F.min("px").alias("low"),
        F.sum("qty").alias("qty"), F.count(F.lit(1)).alias("n_ticks")), "bars")
    decided, price = F.col("_keyed"), {}
    for end in ("first", "last"):
        low, up = (F.col(f"_{end}_{name}").bitwiseAND(NO_PRICE) for name in halves)
        for name, half in (("low", low), ("up", up)):  # the same half, whichever of equal keys has the least and the greatest
            decided = decided & (half + F.col(f"_{end}_{name}_not").bitwiseAND(NO_PRICE) == NO_PRICE)
        decided = decided & (up != NO_PRICE)
        price[end] = (F.shiftleft(up, PRICE_BITS) + low) / 100
    bars = first.select("symbol", "ts", price["first"].alias("open"), "high", "low", price["last"].alias("close"), "qty", "n_ticks",
                        decided.alias("_decided"))
    open_ones = bars.where(~F.col("_decided")).select("symbol", "ts")
    if not open_ones.isEmpty():
        again = ticks.withColumn("_bucket", bucket)
        some = again.join(open_ones.withColumnsRenamed({"symbol": "_s", "ts": "_t"}), F.col("symbol").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_t")), "left_semi")
        ends = some.groupBy(F.col("_bucket").alias("_t"), F.col("symbol").alias("_s")).agg(F.min_by("px", "ord").alias("_open"), F.max_by("px", "ord").alias("_close"))
        bars = (bars.join(ends, F.col("symbol").eqNullSafe(F.col("_s")) & (F.col("ts") == F.col("_t")), "left")
                .withColumn("open", F.when(F.col("_decided"), F.col("open")).otherwise(F.col("_open")))
                .withColumn("close", F.when(F.col("_decided"), F.col("close")).otherwise(F.col("_close"))))
    if not divides_day(every):  # days make up the longer bars
        bars = bars.groupBy(F.window("ts", every).start.alias("ts"), "symbol").agg(
            F.min_by("open", "ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "ts").alias("close"),
            F.sum("qty").alias("qty"), F.sum("n_ticks").alias("n_ticks"))
    return bars.select("symbol", "ts", "open", "high", "low", "close", F.col("qty").cast("long").alias("volume"), "n_ticks")


def divides_day(every: str) -> bool:
    """True when tumbling buckets of ``every`` tile each day exactly."""
    m = re.fullmatch(r"\s*(\d+)\s*(second|seconds|minute|minutes|hour|hours|day|days)\s*", every.lower())
    if not m:
        return False
    n, unit = int(m.group(1)), m.group(2).rstrip("s")
    secs = n * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    return secs > 0 and (86400 % secs == 0 or secs == 86400)


def ohlcv_bar_stream(ticks: DataFrame, every: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """S7 on a tick stream: tumbling windows with a watermark.

    Run it in ``update`` mode to see the current (partial) bar after every
    micro-batch; ``latest_bars`` compacts such a changelog. In ``append`` mode a
    bar is emitted once the watermark passes its end. State older than the
    watermark is dropped.
    """
    return (
        ticks.withColumn("_et", event_time("ts")).withWatermark("_et", delay)
        .groupBy(F.col("symbol"), F.window("_et", every).alias("w"))
        .agg(
            F.min_by("px", "ord").alias("open"),
            F.max("px").alias("high"),
            F.min("px").alias("low"),
            F.max_by("px", "ord").alias("close"),
            F.sum("qty").cast("long").alias("volume"),
            F.count(F.lit(1)).alias("n_ticks"),
        )
        .select("symbol", wall_clock("w.start").alias("ts"), "open", "high", "low", "close", "volume",
                "n_ticks")
    )


def latest_bars(changelog: DataFrame, version: str = "batch_id") -> DataFrame:
    """Last emitted version of every (symbol, ts) bar in an update-mode history."""
    cols = ["open", "high", "low", "close", "volume", "n_ticks"]
    return (changelog.groupBy("symbol", "ts")
            .agg(*[F.max_by(c, version).alias(c) for c in cols]))
