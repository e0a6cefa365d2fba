"""Moving averages, price changes, gains/losses, Wilder averages, RSI.

All lookbacks run per (symbol, chunk) with a halo (see ``sequence``), so the
window sorts are bounded by the chunk size, not by a symbol's length.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions.columns import gain, loss, price_change, rsi_from_averages
from barflow.operators.recurrence import ewm_columns, ewm_scan_columns, halo_rows, has_gaps, span_alpha
from barflow.operators.sequence import DEFAULT_CHUNK_ROWS, chunk_window, effective_chunk_rows, home_rows, over_chunks


def _check_period(n: int) -> int:
    if int(n) != n or n < 1:
        raise ValueError(f"period must be an integer >= 1, got {n}")
    return int(n)


def prefix_means(chunked: DataFrame, specs: Mapping[str, tuple[str, int]], keys: Sequence[str] | str, seq: str, rows: int) -> DataFrame:
    """Add, for each ``name -> (source column, n)``, the mean of the last n rows of the chunk, NULL unless all n have a value.

    Each source has one running sum a chunk and every mean is a difference of two of its values, so the cost of a
    row does not depend on n. The sums are compensated: a value is split into a multiple of a unit, a power of two
    so chosen from the chunk's largest value that ``rows`` of them add up without rounding, and the small rest, whose
    sum's error is about 2^-61 of the largest value. A window with a value that is not finite has the mean NaN.
    ``rows``: bound of a chunk's rows, copies included.
    """
    w = chunk_window(keys, seq)
    whole, upto = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), w.rowsBetween(Window.unboundedPreceding, 0)
    sources = list(dict.fromkeys(src for src, _ in specs.values()))
    bits = 51 - int(rows).bit_length()
    columns = list(chunked.columns)
    finite = {src: F.abs(F.col(src)) < F.lit(float("inf")) for src in sources}
    tops = [F.max(F.when(finite[src], F.abs(F.col(src)))).over(whole).alias(f"_top{i}") for i, src in enumerate(sources)]
    out = chunked.select("*", *tops)
    parts = []
    for i, src in enumerate(sources):
        unit = F.when(F.col(f"_top{i}") > 0, F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(f"_top{i}")) - bits, F.lit(-1000)))).otherwise(F.lit(1.0))
        x = F.when(finite[src], F.col(src).cast("double"))
        large = F.rint(x / unit) * unit
        parts += [large.alias(f"_hi{i}"), (x - large).alias(f"_lo{i}")]
    out = out.select(*columns, *parts)
    zero = F.lit(0.0)
    sums = [F.struct(F.coalesce(F.sum(f"_hi{i}").over(upto), zero).alias("hi"), F.coalesce(F.sum(f"_lo{i}").over(upto), zero).alias("lo"),
                     F.count(src).over(upto).alias("n"), F.count(f"_hi{i}").over(upto).alias("ok")).alias(f"_sum{i}")
            for i, src in enumerate(sources)]
    out = out.select(*columns, *sums)
    before = [F.lag(f"_sum{sources.index(src)}", n).over(w).alias(f"_before_{name}") for name, (src, n) in specs.items()]
    out = out.select("*", *before)
    means = []
    for name, (src, n) in specs.items():
        now, then = F.col(f"_sum{sources.index(src)}"), F.col(f"_before_{name}")
        part = {f: now[f] - F.coalesce(then[f], F.lit(0)) for f in ("hi", "lo", "n", "ok")}
        mean = F.when(part["ok"] == n, (part["hi"] + part["lo"]) / n).otherwise(F.lit(float("nan")))
        means.append(F.when(part["n"] == n, mean).alias(name))
    return out.select(*columns, *means)


def rolling_means(df: DataFrame, specs: Mapping[str, int], src: str = "close",
                  keys: Sequence[str] | str = ("symbol",), seq: str = "seq",
                  with_prev: bool = True, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Mean of the last n rows, NULL until n non-NULL values exist.

    ``prev_<name>`` is the previous row's mean, a lag over the same order, so the
    chunk is sorted once for all columns.
    """
    periods = {k: _check_period(v) for k, v in specs.items()}
    halo = max(periods.values()) + (1 if with_prev else 0)
    w = chunk_window(keys, seq)
    out = prefix_means(over_chunks(df, halo, chunk_rows, seq), {k: (src, n) for k, n in periods.items()}, keys, seq,
                       effective_chunk_rows(halo, chunk_rows) + halo)
    if with_prev:
        out = out.select("*", *[F.lag(name).over(w).alias(f"prev_{name}") for name in periods])
    return home_rows(out)


def sma(df: DataFrame, n: int, src: str = "close", out: str = "sma", **kw) -> DataFrame:
    return rolling_means(df, {out: n}, src=src, with_prev=False, **kw)


def gains_losses(df: DataFrame, n: int | None = None, src: str = "close",
                 keys: Sequence[str] | str = ("symbol",), seq: str = "seq",
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """I3 price_change, I4 gain/loss and, when ``n`` is given, I5 rolling_gain /
    rolling_loss (mean of the last n, first at row n) in one window pass."""
    halo = 1 + (_check_period(n) if n else 0)
    w = chunk_window(keys, seq)
    ch = over_chunks(df, halo, chunk_rows, seq)
    delta = price_change(F.lag(src, 1).over(w), F.col(src))
    ch = ch.withColumn("price_change", delta)
    ch = ch.withColumn("gain", gain("price_change")).withColumn("loss", loss("price_change"))
    if n:
        ch = prefix_means(ch, {f"rolling_{c}": (c, n) for c in ("gain", "loss")}, keys, seq, effective_chunk_rows(halo, chunk_rows) + halo)
    return home_rows(ch)


def _ewm(method: str, alphas, chunk_rows: int, gaps=None):
    """'halo' (one pass), 'scan' (exact affine scan) or 'auto': halo unless it would
    exceed a quarter chunk (very long spans) or ``gaps()`` says that values are missing
    inside a series of several chunks, then scan. Both give the same values up to rounding."""
    if method == "auto":
        method = "halo" if 4 * max(halo_rows(a) for a in alphas) <= chunk_rows else "scan"
        if method == "halo" and gaps is not None and gaps():
            method = "scan"
    if method == "halo":
        return ewm_columns
    if method == "scan":
        return ewm_scan_columns
    raise ValueError("method must be 'auto', 'halo' or 'scan'")


def _ewm_of(method: str, df: DataFrame, specs, keys, seq: str, chunk_rows: int):
    """The method for the columns of ``specs``."""
    sources = list(dict.fromkeys(src for src, _ in specs.values()))
    return _ewm(method, [a for _, a in specs.values()], chunk_rows, lambda: has_gaps(df, sources, keys, seq, chunk_rows))


def rsi_many(df: DataFrame, periods: Sequence[int], keys: Sequence[str] | str = ("symbol",),
             seq: str = "seq", chunk_rows: int = DEFAULT_CHUNK_ROWS, method: str = "auto") -> DataFrame:
    """RSI for several periods at once: ``rsi_<n>`` and ``prev_rsi_<n>``.

    One window pass for the price change and every period's seed means, one
    recurrence pass for every period's Wilder averages."""
    ns = sorted({_check_period(n) for n in periods})
    w = chunk_window(keys, seq)
    halo = 1 + max(ns)
    ch = over_chunks(df, halo, chunk_rows, seq)
    ch = ch.withColumn("price_change", price_change(F.lag("close", 1).over(w), F.col("close")))
    ch = ch.withColumn("gain", gain("price_change")).withColumn("loss", loss("price_change"))
    seeds = {f"_w_{c}_{n}": (c, n) for n in ns for c in ("gain", "loss")}
    ch = prefix_means(ch, seeds, keys, seq, effective_chunk_rows(halo, chunk_rows) + halo)
    for name, (c, n) in seeds.items():
        ch = ch.withColumn(name, F.when(F.col(seq) == n, F.col(name)).when(F.col(seq) > n, F.col(c)))
    seeded = home_rows(ch)
    specs = {}
    for n in ns:
        specs[f"avg_gain_{n}"] = (f"_w_gain_{n}", 1.0 / n)
        specs[f"avg_loss_{n}"] = (f"_w_loss_{n}", 1.0 / n)
    run = _ewm_of(method, seeded, specs, keys, seq, chunk_rows)
    out = run(seeded, specs, keys=keys, seq=seq, with_prev=True, chunk_rows=chunk_rows)
    for n in ns:
        out = (out.withColumn(f"rsi_{n}", rsi_from_averages(f"avg_gain_{n}", f"avg_loss_{n}"))
                  .withColumn(f"prev_rsi_{n}", rsi_from_averages(f"prev_avg_gain_{n}", f"prev_avg_loss_{n}")))
    drop = [c for c in out.columns if c.startswith(("_w_", "avg_", "prev_avg_"))]
    return out.drop(*drop)


def ema(df: DataFrame, spans: Mapping[str, int], src: str = "close", with_prev: bool = True,
        keys: Sequence[str] | str = ("symbol",), seq: str = "seq",
        chunk_rows: int = DEFAULT_CHUNK_ROWS, method: str = "auto") -> DataFrame:
    """Exponential means with alpha = 2/(span+1), no warm-up gap.

    ``method="halo"``: one pass, chunks warm up on a halo; ``method="scan"``:
    exact three-pass affine scan (Y4); ``"auto"`` picks halo for ordinary spans."""
    specs = {name: (src, span_alpha(_check_period(s))) for name, s in spans.items()}
    run = _ewm_of(method, df, specs, keys, seq, chunk_rows)
    return run(df, specs, keys=keys, seq=seq, with_prev=with_prev, chunk_rows=chunk_rows)


def wilder(df: DataFrame, n: int, keys: Sequence[str] | str = ("symbol",), seq: str = "seq",
           with_prev: bool = True, chunk_rows: int = DEFAULT_CHUNK_ROWS, method: str = "auto") -> DataFrame:
    """Wilder averages of gain and loss.

    Missing before row n; row n holds the mean of the gains of rows 1..n;
    from row n+1 on a_t = ((n-1)/n)·a_{t-1} + (1/n)·g_t.
    Expects ``gains_losses(df, n)`` columns.
    """
    n = _check_period(n)
    seeded = df
    for c in ("gain", "loss"):
        seeded = seeded.withColumn(
            f"_w_{c}",
            F.when(F.col(seq) < n, F.lit(None).cast("double"))
             .when(F.col(seq) == n, F.col(f"rolling_{c}"))
             .otherwise(F.col(c)))
    specs = {"avg_gain": ("_w_gain", 1.0 / n), "avg_loss": ("_w_loss", 1.0 / n)}
    run = _ewm_of(method, seeded, specs, keys, seq, chunk_rows)
    out = run(seeded, specs, keys=keys, seq=seq, with_prev=with_prev, chunk_rows=chunk_rows)
    return out.drop("_w_gain", "_w_loss")


def rsi(df: DataFrame, n: int, keys: Sequence[str] | str = ("symbol",), seq: str = "seq",
        chunk_rows: int = DEFAULT_CHUNK_ROWS, method: str = "auto") -> DataFrame:
    """RSI and the previous row's RSI from Wilder averages."""
    g = gains_losses(df, n, keys=keys, seq=seq, chunk_rows=chunk_rows)
    w = wilder(g, n, keys=keys, seq=seq, with_prev=True, chunk_rows=chunk_rows, method=method)
    return (w.withColumn("rsi", rsi_from_averages("avg_gain", "avg_loss"))
             .withColumn("prev_rsi", rsi_from_averages("prev_avg_gain", "prev_avg_loss")))

