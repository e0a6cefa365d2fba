"""Exponential recurrences y_t = (1-a)·y_{t-1} + a·x_t along a long series.

No window function can feed back its own output, so the recurrence runs in a
grouped pandas function (``ewm(adjust=False)``, a compiled loop). Groups are
(key, chunk) with a halo of H earlier rows, never a whole symbol:

    H = ceil(64·ln 2 / -ln(1-a))   so that (1-a)^H <= 2^-64.

Inside chunk c > 0 the recurrence starts H rows early from the observed value
there. Whatever that start differs from the true value by is scaled by
(1-a)^H <= 2^-64 at the chunk's first home row, below the rounding of a double
for inputs of bounded range, so the chunked result matches a single pass to
within rounding (tests check 1e-12 relative). Chunk 0 starts at the series'
first row exactly like a single pass.

``affine_scan`` is the exact alternative, up to floating-point rounding (three
passes: per-chunk composition, a scan over the per-chunk summaries, re-application); ``ewm_scan_columns``
builds EMA/Wilder on it (``method="scan"`` in the indicator functions).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators.sequence import (
    CHUNK, DEFAULT_CHUNK_ROWS, HOME, _keys, chunk_of, chunk_window, join_on, over_chunks,
)

# Maps that ``apply_maps`` applies one after the other.
BLOCK = 512


def halo_rows(alpha: float, bits: int = 64) -> int:
    if not 0 < alpha <= 1:
        raise ValueError(f"alpha must be in (0, 1], got {alpha}")
    if alpha == 1:
        return 1
    return int(math.ceil(bits * math.log(2) / -math.log1p(-alpha)))


def span_alpha(span: int) -> float:
    if span < 1:
        raise ValueError("span must be >= 1")
    return 2.0 / (span + 1)


def ewm_columns(df: DataFrame, specs: Mapping[str, tuple[str, float]],
                keys: Sequence[str] | str = ("symbol",), seq: str = "seq",
                with_prev: bool = True, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Add one column per ``name -> (source column, alpha)``.

    Semantics of ``pandas.Series.ewm(alpha, adjust=False).mean()``: the first
    non-NULL source value starts the series; a NULL source row repeats the last
    value; after k NULL rows the next value weighs the carried one by
    (1-a)^(k+1). ``prev_<name>`` holds the previous row's value.
    """
    ks = _keys(keys)
    halo = max(halo_rows(a) for _, a in specs.values()) + (1 if with_prev else 0)
    chunked = over_chunks(df, halo, chunk_rows, seq)
    fields = [f for f in df.schema.fields]
    for name in specs:
        fields.append(T.StructField(name, T.DoubleType()))
        if with_prev:
            fields.append(T.StructField(f"prev_{name}", T.DoubleType()))
    out_schema = T.StructType(fields)
    out_cols = [f.name for f in fields]
    spec_items = list(specs.items())

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(seq, kind="stable")
        for name, (src, alpha) in spec_items:
            y = pdf[src].astype("float64").ewm(alpha=alpha, adjust=False).mean()
            pdf[name] = y
            if with_prev:
                pdf[f"prev_{name}"] = y.shift(1)
        pdf = pdf[pdf[HOME].astype(bool)]
        return pdf[out_cols]

    return chunked.groupBy(*ks, CHUNK).applyInPandas(run, out_schema)


def compose_maps(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """The map y -> A·y + B that the maps y -> a_t·y + b_t make in order: neighbours are composed pairwise in log steps."""
    while len(a) > 1:
        if len(a) % 2:
            a, b = np.append(a, 1.0), np.append(b, 0.0)
        a, b = a[1::2] * a[::2], a[1::2] * b[::2] + b[1::2]
    return (float(a[0]), float(b[0])) if len(a) else (1.0, 0.0)


def apply_maps(a: np.ndarray, b: np.ndarray, y: float) -> np.ndarray:
    """All y_t = a_t·y_{t-1} + b_t from ``y``: blocks of ``BLOCK`` maps side by side, step by step, then from block to block.

    The blocks are composed and their entering values found the same way, so the work in Python is ``BLOCK``
    array steps a level. A block whose maps wipe the past (a product of 0, also by underflow) is then exact by itself.
    """
    n = len(a)
    if n <= BLOCK:
        out = np.empty(n)
        for t, (x_a, x_b) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            y = x_a * y + x_b
            out[t] = y
        return out
    rows = -(-n // BLOCK)
    pad = rows * BLOCK - n
    wide_a, wide_b = np.append(a, np.ones(pad)).reshape(rows, BLOCK), np.append(b, np.zeros(pad)).reshape(rows, BLOCK)
    big_a, big_b = np.ones(rows), np.zeros(rows)
    for t in range(BLOCK):
        big_a, big_b = wide_a[:, t] * big_a, wide_a[:, t] * big_b + wide_b[:, t]
    now = np.append(y, apply_maps(big_a, big_b, y)[:-1])
    out = np.empty((rows, BLOCK))
    for t in range(BLOCK):
        now = wide_a[:, t] * now + wide_b[:, t]
        out[:, t] = now
    return out.ravel()[:n]


def affine_scan(df: DataFrame, series: Sequence[tuple[str, str, str]],
                keys: Sequence[str] | str = ("symbol",), seq: str = "seq",
                chunk_rows: int = DEFAULT_CHUNK_ROWS, with_prev: bool = False) -> DataFrame:
    """y_t = a_t·y_{t-1} + b_t per key along ``seq`` (y_{-1} = 0), for each
    ``(a column, b column, output column)`` in ``series``.

    Affine maps compose, so the scan is exact (up to floating-point rounding) in
    three passes, none of which holds more than a chunk:
      1. per (key, chunk): compose the chunk's maps into one (A, B);
      2. per key, over the one-row-per-chunk summaries: the value entering each
         chunk (this table has rows/chunk_rows rows per key);
      3. per (key, chunk): re-apply the maps from that value.
    With ``with_prev`` the previous row's value is emitted as ``prev_<out>``.
    """
    ks = _keys(keys)
    chunked = df.withColumn(CHUNK, F.expr(f"`{seq}` div {int(chunk_rows)}"))
    a_cols = [a for a, _, _ in series]
    b_cols = [b for _, b, _ in series]
    outs = [o for _, _, o in series]

    summary_fields = [chunked.schema[k] for k in ks] + [T.StructField(CHUNK, T.LongType())]
    summary_fields += [T.StructField(f"_A{i}", T.DoubleType()) for i in range(len(series))]
    summary_fields += [T.StructField(f"_B{i}", T.DoubleType()) for i in range(len(series))]
    summary_schema = T.StructType(summary_fields)

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(seq, kind="stable")
        row = {k: pdf[k].iloc[0] for k in ks}
        row[CHUNK] = int(pdf[CHUNK].iloc[0])
        for i, (a, b) in enumerate(zip(a_cols, b_cols)):
            row[f"_A{i}"], row[f"_B{i}"] = compose_maps(pdf[a].to_numpy(), pdf[b].to_numpy())
        return pd.DataFrame([row])

    carry_fields = summary_fields[: len(ks) + 1] + [T.StructField(f"_Y{i}", T.DoubleType())
                                                    for i in range(len(series))]
    carry_schema = T.StructType(carry_fields)

    def prefix(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(CHUNK, kind="stable").reset_index(drop=True)
        out = pdf[[*ks, CHUNK]].copy()
        for i in range(len(series)):
            after = apply_maps(pdf[f"_A{i}"].to_numpy(), pdf[f"_B{i}"].to_numpy(), 0.0)
            out[f"_Y{i}"] = np.append(0.0, after[:-1])
        return out

    summaries = (chunked.select(*ks, CHUNK, seq, *a_cols, *b_cols)
                 .groupBy(*ks, CHUNK).applyInPandas(compose, summary_schema))
    carry = summaries.groupBy(*ks).applyInPandas(prefix, carry_schema)

    fields = list(df.schema.fields)
    for o in outs:
        fields.append(T.StructField(o, T.DoubleType()))
        if with_prev:
            fields.append(T.StructField(f"prev_{o}", T.DoubleType()))
    out_schema = T.StructType(fields)
    out_names = [f.name for f in fields]

    def apply(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(seq, kind="stable")
        for i, (a, b, o) in enumerate(series):
            y = float(pdf[f"_Y{i}"].iloc[0])
            ys = apply_maps(pdf[a].to_numpy(), pdf[b].to_numpy(), y)
            pdf[o] = ys
            if with_prev:
                pdf[f"prev_{o}"] = np.append(y, ys[:-1])
        return pdf[out_names]

    joined = join_on(chunked, carry, [*ks, CHUNK])
    return joined.groupBy(*ks, CHUNK).applyInPandas(apply, out_schema)


def ewm_scan_columns(df: DataFrame, specs: Mapping[str, tuple[str, float]],
                     keys: Sequence[str] | str = ("symbol",), seq: str = "seq",
                     with_prev: bool = True, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``ewm_columns`` computed with the exact ``affine_scan``.

    Same rule as there: per source column the first non-NULL row of a key starts
    the series (a = 0, b = x); a value after k NULL rows weighs the carried one by
    w = (1-alpha)^(k+1) against alpha, so a = w / (w + alpha), b = (1 - a)·x (alpha
    as pandas derives it); a NULL row repeats the last value (a = 1, b = 0). Values
    before the start are NULL. The start and the last value before a chunk come
    from one aggregate with one row per (key, chunk) and one join, whatever the
    number of columns.
    """
    ks = _keys(keys)
    sources = list(dict.fromkeys(src for src, _ in specs.values()))
    d = df.withColumn(CHUNK, chunk_of(seq, chunk_rows))
    valued = {src: F.when(F.col(src).isNotNull(), F.col(seq)) for src in sources}
    summary = d.groupBy(*ks, CHUNK).agg(*[F.min(v).alias(f"_lo{i}") for i, v in enumerate(valued.values())],
                                        *[F.max(v).alias(f"_hi{i}") for i, v in enumerate(valued.values())])
    prior = Window.partitionBy(*ks).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*ks, CHUNK,
                             *[F.min(f"_lo{i}").over(Window.partitionBy(*ks)).alias(f"_first{i}") for i in range(len(sources))],
                             *[F.max(f"_hi{i}").over(prior).alias(f"_carry{i}") for i in range(len(sources))])
    d = join_on(d, summary, [*ks, CHUNK])
    earlier = chunk_window(ks, seq).rowsBetween(Window.unboundedPreceding, -1)
    d = d.select("*", *[F.coalesce(F.last(v, ignorenulls=True).over(earlier), F.col(f"_carry{i}")).alias(f"_before{i}")
                        for i, v in enumerate(valued.values())])
    series = []
    for i, (name, (src, alpha)) in enumerate(specs.items()):
        j = sources.index(src)
        a_eff = 1.0 / (1.0 + (1.0 - alpha) / alpha)
        x, s, f = F.col(src), F.col(seq), F.col(f"_first{j}")
        w = F.pow(F.lit(1.0 - a_eff), s - F.col(f"_before{j}"))
        kept = w / (w + F.lit(a_eff))
        d = (d.withColumn(f"_a{i}", F.when(x.isNull(), F.lit(1.0)).when(s == f, F.lit(0.0)).otherwise(kept))
              .withColumn(f"_b{i}", F.when(x.isNull(), F.lit(0.0)).when(s == f, x)
                          .otherwise(F.lit(a_eff) / (w + F.lit(a_eff)) * x)))
        series.append((f"_a{i}", f"_b{i}", name))
    d = d.drop(CHUNK, *[f"_carry{j}" for j in range(len(sources))], *[f"_before{j}" for j in range(len(sources))])
    out = affine_scan(d, series, keys=ks, seq=seq, chunk_rows=chunk_rows, with_prev=with_prev)
    for i, (name, (src, _)) in enumerate(specs.items()):
        f = F.col(f"_first{sources.index(src)}")
        out = out.withColumn(name, F.when(f.isNotNull() & (F.col(seq) >= f), F.col(name)))
        if with_prev:
            out = out.withColumn(f"prev_{name}", F.when(f.isNotNull() & (F.col(seq) - 1 >= f),
                                                        F.col(f"prev_{name}")))
        out = out.drop(f"_a{i}", f"_b{i}")
    return out.drop(*[f"_first{j}" for j in range(len(sources))])


def has_gaps(df: DataFrame, sources: Sequence[str], keys: Sequence[str] | str = ("symbol",), seq: str = "seq",
             chunk_rows: int = DEFAULT_CHUNK_ROWS) -> bool:
    """Whether a key longer than one chunk has a NULL after its first value in any source column.

    One aggregate with one row per key; only the flag comes to the driver.
    """
    gap = F.lit(False)
    for src in sources:
        first = F.min(F.when(F.col(src).isNotNull(), F.col(seq)))
        gap = gap | F.coalesce(F.max(seq) - first + 1 != F.count(src), F.lit(False))
    found = df.groupBy(*_keys(keys)).agg((gap & (F.max(seq) >= chunk_rows)).alias("gap"))
    return bool(found.where("gap").limit(1).count())
