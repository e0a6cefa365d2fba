"""S2-S4, S6 and quarantine: the JSON wire format of one bar.

Message value = UTF-8 JSON ``{"timestamp": epoch ms, "open", "high", "low",
"close", "volume"}``; we also carry ``symbol`` (key and field).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.functions.columns import valid_price
from barflow.schema import BAR_COLUMNS, UPSTREAM_FIELDS, WIRE_SCHEMA

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def encode_bars(bars: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bars -> (key, value) binary rows, ready for a kafka or file sink.

    ``keep`` columns are carried along unchanged (e.g. a replay slice)."""
    ms = F.expr(f"timestampdiff(MILLISECOND, {_EPOCH}, ts)")
    payload = F.struct(
        F.col("symbol"), ms.alias("timestamp"), "open", "high", "low", "close",
        F.col("volume").cast("double").alias("volume"))
    return bars.select(*keep, F.col("symbol").cast("binary").alias("key"),
                       F.to_json(payload).cast("binary").alias("value"))


def decode_bars(raw: DataFrame, value: str = "value", key: str = "key") -> DataFrame:
    """binary/string JSON -> ``data`` struct, the raw text ``_text`` (kept for
    the dead-letter table) and the message key ``_key`` when the source has one."""
    text = F.col(value).cast("string")
    parsed = F.from_json(text, WIRE_SCHEMA)
    msg_key = F.col(key).cast("string") if key in raw.columns else F.lit(None).cast("string")
    return raw.select(parsed.alias("data"), text.alias("_text"), msg_key.alias("_key"))


def normalise_ts(decoded: DataFrame, keep_millis: bool = False, default_symbol: str | None = None) -> DataFrame:
    """S3: epoch ms -> wall-clock UTC timestamp and flat bar columns.

    Reference rule: ms div 1000 (sub-second part dropped, truncation toward
    zero); ``keep_millis`` keeps it instead. Volume decoded as a double is cast
    to bigint. The symbol is the message's ``symbol`` field, else the message
    key, else ``default_symbol`` (messages of a single-ticker feed carry none).
    """
    ms = F.col("data.timestamp")
    if keep_millis:
        ts = F.expr(f"timestampadd(MILLISECOND, data.timestamp, {_EPOCH})")
    else:
        ts = F.expr(f"timestampadd(SECOND, data.timestamp div 1000, {_EPOCH})")
    symbol = F.coalesce(F.col("data.symbol"), F.col("_key"), F.lit(default_symbol).cast("string"))
    return decoded.select(
        symbol.alias("symbol"),
        F.when(ms.isNotNull(), ts).alias("ts"),
        F.col("data.open").alias("open"), F.col("data.high").alias("high"),
        F.col("data.low").alias("low"), F.col("data.close").alias("close"),
        F.col("data.volume").cast("long").alias("volume"),
        F.col("_text"),
    )


def split_quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars usable by strategies, and the dead-letter rest: missing symbol or ts,
    or a close that is missing, NaN, infinite or <= 0 (sizing divides by it)."""
    ok = F.col("symbol").isNotNull() & F.col("ts").isNotNull() & valid_price("close")
    good = rows.filter(ok).select(*BAR_COLUMNS)
    bad = rows.filter(~ok | ok.isNull())
    return good, bad


def rename_bar_fields(upstream: DataFrame) -> DataFrame:
    """Short upstream names (t, o, h, l, c, v) -> long names."""
    cols = [F.col(c).alias(UPSTREAM_FIELDS.get(c, c)) for c in upstream.columns]
    return upstream.select(*cols)
