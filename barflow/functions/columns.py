"""Column-expression helpers. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barflow.schema import RSI_HIGH, RSI_LOW


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def valid_price(x) -> Column:
    """Not NULL, not NaN, finite and > 0 (Spark orders NaN above every number, so
    ``> 0`` alone would let it through)."""
    c = _c(x)
    return c.isNotNull() & ~F.isnan(c) & (c > 0) & (c < F.lit(float("inf")))


def round_half_up(x, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d.

    Used for every double that leaves a query: plain IEEE steps, so any engine
    that multiplies, adds and floors gives the same value.
    """
    scale = float(10 ** digits)
    return (F.floor(_c(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def price_change(prev_close, close) -> Column:
    """x_t - x_{t-1}; NULL on the first bar."""
    return _c(close) - _c(prev_close)


def gain(delta) -> Column:
    """max(delta, 0), NULL stays NULL (``greatest`` alone would skip the NULL)."""
    d = _c(delta)
    return F.when(d.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(d, F.lit(0.0)))


def loss(delta) -> Column:
    """max(-delta, 0), NULL stays NULL."""
    d = _c(delta)
    return F.when(d.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(-d, F.lit(0.0)))


def rsi_from_averages(avg_gain, avg_loss) -> Column:
    """100 - 100 / (1 + avg_gain/avg_loss); no losses -> 100, flat -> NULL."""
    g, l_ = _c(avg_gain), _c(avg_loss)
    return (F.when(l_ == 0, F.when(g == 0, F.lit(None).cast("double")).otherwise(F.lit(100.0)))
            .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / l_)))


def cross_signal(prev_fast, prev_slow, fast, slow) -> Column:
    """+1 when fast crosses above slow, -1 when it crosses below, else 0.

    Ties count as "not crossed yet"; any NULL operand gives 0.
    """
    pf, ps, f, s = _c(prev_fast), _c(prev_slow), _c(fast), _c(slow)
    known = pf.isNotNull() & ps.isNotNull() & f.isNotNull() & s.isNotNull()
    return (F.when(known & (pf <= ps) & (f > s), F.lit(1))
            .when(known & (pf >= ps) & (f < s), F.lit(-1))
            .otherwise(F.lit(0)))


def threshold_signal(prev, cur, low: float = RSI_LOW, high: float = RSI_HIGH) -> Column:
    """+1 when leaving the low zone upward, -1 when leaving the high zone downward."""
    p, c = _c(prev), _c(cur)
    known = p.isNotNull() & c.isNotNull()
    return (F.when(known & (p <= low) & (c > low), F.lit(1))
            .when(known & (p >= high) & (c < high), F.lit(-1))
            .otherwise(F.lit(0)))


def money_text(value) -> Column:
    """'Ending cash: $x.xx'."""
    return F.format_string("Ending cash: $%.2f", round_half_up(value, 2))


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def event_time(name: str) -> Column:
    """Wall-clock (NTZ) column -> instant, reading the wall clock as UTC whatever
    the session time zone. Watermarks and stream windows need an instant."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{name}`)"))


def wall_clock(instant: str) -> Column:
    """Inverse of ``event_time`` for an instant column or field name."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({instant}), {_EPOCH_NTZ})")
