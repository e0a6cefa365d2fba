"""Per-symbol bar index and chunked evaluation.

Everything that looks back along a symbol's bars (rolling means, lags,
recurrences, running state) is evaluated per (symbol, chunk) instead of per
symbol, so one symbol's series is spread over many tasks however long it is:

* ``with_seq`` numbers the bars of each key 0, 1, 2, ... without sorting a key
  in one task: it counts bars per (key, time segment), prefix-sums those counts
  on the small count table and adds a row number inside each segment.
* ``over_chunks`` cuts the index into chunks of ``chunk_rows`` (at least four
  halos) and copies the last ``halo`` rows of each chunk into the next one(s),
  so a lookback of up to ``halo`` rows is exact inside every chunk.
  ``home_rows`` drops the copies.
* ``ffill_last`` carries the latest flagged row forward along the index: a
  window inside each chunk plus a carry from the small per-chunk summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "_chunk"
HOME = "_home"
DEFAULT_CHUNK_ROWS = 250_000
DEFAULT_SEGMENT_SECONDS = 32 * 86_400


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on the columns ``on`` with NULL matching NULL (``<=>``), keeping
    one copy of each join column, like ``left.join(right, on, how)``.

    A NULL in a key column then forms its own series, as it does in
    ``groupBy`` and window partitions. Spark still plans ``<=>`` keys as a hash,
    sort-merge or broadcast equi-join."""
    on = list(on)
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on])
    cond = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in on]
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in on])


def with_seq(df: DataFrame, keys: Sequence[str] | str = ("symbol",), order: str = "ts",
             seq: str = "seq", segment_seconds: int = DEFAULT_SEGMENT_SECONDS) -> DataFrame:
    """Add a dense 0-based index per key in ``order`` (unique per key) order.

    Rows are spread over tasks by (key, segment) and no window group is larger
    than one segment: the bars of ``segment_seconds`` (32 days by default; use
    less for sub-minute bars). The count table has one row per (key, segment)
    and is the only input of the prefix sum.
    """
    ks = _keys(keys)
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{order}`)")
    seg = F.floor(micros / F.lit(int(segment_seconds) * 1_000_000))
    d = df.withColumn("_seg", seg)
    counts = d.groupBy(*ks, "_seg").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*ks).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*ks, "_seg", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # Remaining columns break ties, so the numbering is the same on every
    # attempt of a task even if a (key, ts) pair repeats (dedupe bars first).
    ties = [c for c in df.columns if c not in (*ks, order)
            and not isinstance(df.schema[c].dataType, (T.MapType, T.ArrayType))]
    inside = Window.partitionBy(*ks, "_seg").orderBy(order, *ties)
    return (
        join_on(d, offsets, [*ks, "_seg"])
        .withColumn(seq, (F.col("_off") + F.row_number().over(inside) - 1).cast("long"))
        .drop("_seg", "_off")
    )


def effective_chunk_rows(halo: int, chunk_rows: int) -> int:
    """Chunks hold at least 4 halos, so copied rows stay under 25% of the data."""
    return max(int(chunk_rows), 4 * int(halo), 1)


def chunk_of(seq: str, chunk_rows: int) -> Column:
    return F.expr(f"`{seq}` div {int(chunk_rows)}")


def over_chunks(df: DataFrame, halo: int, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                seq: str = "seq") -> DataFrame:
    """Assign each row to its chunk and copy it into the following chunks whose
    first ``halo`` rows need it. Adds ``_chunk`` and ``_home``."""
    if halo < 0:
        raise ValueError("halo must be >= 0")
    chunk_rows = effective_chunk_rows(halo, chunk_rows)
    home = chunk_of(seq, chunk_rows)
    last = F.expr(f"(`{seq}` + {int(halo)}) div {int(chunk_rows)}")
    return (df.withColumn(CHUNK, F.explode(F.sequence(home, last)))
              .withColumn(HOME, F.col(CHUNK) == home))


def chunk_window(keys: Sequence[str] | str, seq: str = "seq"):
    return Window.partitionBy(*_keys(keys), CHUNK).orderBy(seq)


def home_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(HOME)).drop(CHUNK, HOME)


def ffill_last(df: DataFrame, flag: str, cols: Sequence[str], keys: Sequence[str] | str = ("symbol",),
               seq: str = "seq", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Replace ``cols`` on every row by their values on the latest row at or
    before it (by ``seq``) where ``flag`` is true; NULL before the first one."""
    ks = _keys(keys)
    d = df.withColumn(CHUNK, chunk_of(seq, chunk_rows))
    flagged_seq = F.when(F.col(flag), F.col(seq))
    # One row per (key, chunk): the chunk's last flagged values.
    summary = d.groupBy(*ks, CHUNK).agg(
        *[F.max_by(F.col(c), flagged_seq).alias(f"_s_{c}") for c in cols],
        F.max(flagged_seq).alias("_s_seq"),
    )
    prior = Window.partitionBy(*ks).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry_seq = F.last("_s_seq", ignorenulls=True).over(prior)
    carry = summary.select(
        *ks, CHUNK,
        *[F.last(F.when(F.col("_s_seq").isNotNull(), F.col(f"_s_{c}")), ignorenulls=True)
          .over(prior).alias(f"_c_{c}") for c in cols],
        carry_seq.alias("_c_seq"),
    )
    upto = chunk_window(ks, seq).rowsBetween(Window.unboundedPreceding, 0)
    out = join_on(d, carry, [*ks, CHUNK], "left").select(
        "*",
        F.last(flagged_seq, ignorenulls=True).over(upto).alias("_l_seq"),
        *[F.last(F.when(F.col(flag), F.col(c)), ignorenulls=True).over(upto).alias(f"_l_{c}") for c in cols],
    )
    filled = [F.when(F.col("_l_seq").isNotNull(), F.col(f"_l_{c}"))
              .when(F.col("_c_seq").isNotNull(), F.col(f"_c_{c}")).alias(c) for c in cols]
    keep = [c for c in df.columns if c not in cols]
    return out.select(*keep, *filled)
