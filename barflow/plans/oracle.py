"""Oracle SQL (DuckDB dialect) for every catalog query.

Written independently of the Spark plans: ordered aggregates for bars, window
SQL for rolling means and lags, recursive CTEs for the exponential averages
and for the ledger fold. Tables are the driver's views (lineitem, orders,
events). Doubles are rounded with the same floor(x*10^d + 0.5)/10^d rule.
"""

from __future__ import annotations

from barflow.plans import catalog as C


def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def r(x: str, digits: int) -> str:
    scale = dbl(10.0 ** digits)
    return f"(floor(({x}) * {scale} + {dbl(0.5)}) / {scale})"


def r6(x):
    return r(x, 6)


def r2(x):
    return r(x, 2)


# ---------------------------------------------------------------- bars
_TICKS = {
    "L": ("""SELECT l_returnflag AS symbol, l_shipdate AS t0,
                 floor((l_extendedprice / l_quantity) * {h} + {half}) / {h} AS px,
                 l_quantity AS qty, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity
          FROM lineitem WHERE l_shipdate IS NOT NULL AND l_quantity <> 0""",
          "t0, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity", "day"),
    "E": ("""SELECT event_type AS symbol, ts AS t0, value AS px, {one} AS qty, event_id
          FROM events WHERE ts IS NOT NULL""", "t0, event_id", "hour"),
    "O": ("""SELECT o_orderpriority AS symbol, o_orderdate AS t0, o_totalprice AS px, {one} AS qty, o_orderkey
          FROM orders WHERE o_orderdate IS NOT NULL""", "t0, o_orderkey", "day"),
}


def bars_sql(frame: str) -> str:
    ticks, order, unit = _TICKS[frame]
    ticks = ticks.format(h=dbl(100.0), half=dbl(0.5), one=dbl(1.0))
    desc = ", ".join(f"{c.strip()} DESC" for c in order.split(","))
    return f"""SELECT symbol, date_trunc('{unit}', t0) AS ts,
        first(px ORDER BY {order}) AS open, max(px) AS high, min(px) AS low,
        first(px ORDER BY {desc}) AS close, CAST(sum(qty) AS BIGINT) AS volume, count(*) AS n_ticks
      FROM ({ticks}) t WHERE px IS NOT NULL AND NOT isnan(px) AND isfinite(px) AND px > 0
      GROUP BY symbol, date_trunc('{unit}', t0)"""


def series_ctes(frame: str) -> str:
    return f"""bars AS ({bars_sql(frame)}),
    b AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS seq FROM bars)"""


# ---------------------------------------------------------------- indicators
def sma_expr(n: int, src: str = "close", order: str = "seq", part: str = "symbol") -> str:
    w = f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({src}) OVER {w} = {n} THEN avg({src}) OVER {w} END"


def ewm_step(y: str, x: str, alpha: float) -> str:
    """One step of pandas' adjust=False mean, including its equal-value shortcut."""
    a = 1.0 / (1.0 + (1.0 - alpha) / alpha)   # the alpha pandas derives from ours
    oma = 1.0 - a
    return (f"CASE WHEN {x} IS NULL THEN {y} WHEN {y} IS NULL THEN {x} WHEN {y} = {x} THEN {x} "
            f"ELSE ({dbl(oma)} * {y} + {dbl(a)} * {x}) / ({dbl(oma)} + {dbl(a)}) END")


def cross_expr(pf, ps, f, s) -> str:
    known = f"{pf} IS NOT NULL AND {ps} IS NOT NULL AND {f} IS NOT NULL AND {s} IS NOT NULL"
    return (f"CASE WHEN {known} AND {pf} <= {ps} AND {f} > {s} THEN 1 "
            f"WHEN {known} AND {pf} >= {ps} AND {f} < {s} THEN -1 ELSE 0 END")


def threshold_expr(p, c, low=30.0, high=70.0) -> str:
    known = f"{p} IS NOT NULL AND {c} IS NOT NULL"
    return (f"CASE WHEN {known} AND {p} <= {dbl(low)} AND {c} > {dbl(low)} THEN 1 "
            f"WHEN {known} AND {p} >= {dbl(high)} AND {c} < {dbl(high)} THEN -1 ELSE 0 END")


def rsi_expr(g, l_) -> str:
    h = dbl(100.0)
    return (f"CASE WHEN {l_} = 0 THEN CASE WHEN {g} = 0 THEN NULL ELSE {h} END "
            f"ELSE {h} - {h} / ({dbl(1.0)} + {g} / {l_}) END")


def sma_frame_ctes(fast: int, slow: int, src: str = "b") -> str:
    return f"""ind AS (SELECT *, {sma_expr(fast)} AS fast, {sma_expr(slow)} AS slow FROM {src}),
    frame AS (SELECT *, {cross_expr('lag(fast) OVER w', 'lag(slow) OVER w', 'fast', 'slow')} AS sig
              FROM ind WINDOW w AS (PARTITION BY symbol ORDER BY seq))"""


def ema_frame_ctes(fast: int, slow: int) -> str:
    a1, a2 = 2.0 / (fast + 1), 2.0 / (slow + 1)
    return f"""ema(symbol, seq, fast, slow) AS (
        SELECT symbol, seq, close, close FROM b WHERE seq = 0
        UNION ALL
        SELECT b.symbol, b.seq, {ewm_step('e.fast', 'b.close', a1)}, {ewm_step('e.slow', 'b.close', a2)}
        FROM ema e JOIN b ON b.symbol = e.symbol AND b.seq = e.seq + 1),
    ind AS (SELECT b.*, e.fast, e.slow FROM b JOIN ema e USING (symbol, seq)),
    frame AS (SELECT *, {cross_expr('lag(fast) OVER w', 'lag(slow) OVER w', 'fast', 'slow')} AS sig
              FROM ind WINDOW w AS (PARTITION BY symbol ORDER BY seq))"""


def gains_ctes(n: int, sfx: str = "") -> str:
    zero = dbl(0.0)
    return f"""pc{sfx} AS (SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY seq) AS price_change FROM b),
    gl{sfx} AS (SELECT *, CASE WHEN price_change IS NULL THEN NULL ELSE greatest(price_change, {zero}) END AS gain,
                     CASE WHEN price_change IS NULL THEN NULL ELSE greatest(-price_change, {zero}) END AS loss
           FROM pc{sfx}),
    rg{sfx} AS (SELECT *, {sma_expr(n, 'gain')} AS rolling_gain, {sma_expr(n, 'loss')} AS rolling_loss FROM gl{sfx})"""


def rsi_frame_ctes(n: int, sfx: str = "") -> str:
    a = 1.0 / n
    return f"""{gains_ctes(n, sfx)},
    wl{sfx}(symbol, seq, avg_gain, avg_loss) AS (
        SELECT symbol, seq, rolling_gain, rolling_loss FROM rg{sfx} WHERE seq = {n}
        UNION ALL
        SELECT r.symbol, r.seq, {ewm_step('w.avg_gain', 'r.gain', a)}, {ewm_step('w.avg_loss', 'r.loss', a)}
        FROM wl{sfx} w JOIN rg{sfx} r ON r.symbol = w.symbol AND r.seq = w.seq + 1),
    ind{sfx} AS (SELECT rg{sfx}.*, wl{sfx}.avg_gain, wl{sfx}.avg_loss, {rsi_expr('wl' + sfx + '.avg_gain', 'wl' + sfx + '.avg_loss')} AS rsi
            FROM rg{sfx} LEFT JOIN wl{sfx} USING (symbol, seq)),
    frame{sfx} AS (SELECT *, {threshold_expr('lag(rsi) OVER w', 'rsi')} AS sig
              FROM ind{sfx} WINDOW w AS (PARTITION BY symbol ORDER BY seq))"""


# ---------------------------------------------------------------- ledger
def _step(cash: str, pos: str, sig: str, price: str, halt: bool) -> dict[str, str]:
    zero = "CAST(0 AS BIGINT)"
    flip = f"({pos}) * ({sig}) < 0"
    c1 = f"(CASE WHEN {flip} THEN {cash} + {pos} * {price} ELSE {cash} END)"
    p1 = f"(CASE WHEN {flip} THEN {zero} ELSE {pos} END)"
    can_open = f"({p1} = 0" + (f" AND NOT ({c1} <= 0)" if halt else "") + ")"
    n = f"CAST(trunc({c1} / {price}) AS BIGINT)"
    signed = f"(CASE WHEN {sig} > 0 THEN {n} ELSE -{n} END)"
    return {
        "closed": f"(CASE WHEN {flip} THEN {pos} ELSE {zero} END)",
        "opened": f"(CASE WHEN {can_open} THEN {signed} ELSE {zero} END)",
        "cash": (f"(CASE WHEN {can_open} THEN (CASE WHEN {sig} > 0 THEN {c1} - {n} * {price} "
                 f"ELSE {c1} + {n} * {price} END) ELSE {c1} END)"),
        "pos": f"(CASE WHEN {can_open} THEN {signed} ELSE {p1} END)",
    }


def fold_ctes(cash0: float, halt: bool = False, keys=("symbol",), src: str = "frame") -> str:
    ks = ", ".join(keys)
    on = " AND ".join(f"s.{k} = f.{k}" for k in keys)
    first = _step(dbl(cash0), "CAST(0 AS BIGINT)", "sig", "price", halt)
    nxt = _step("f.cash", "f.pos", "s.sig", "s.price", halt)
    cols = ["closed", "opened", "cash", "pos"]
    return f"""sr AS (SELECT {ks}, seq, ts, sig, close AS price,
                     row_number() OVER (PARTITION BY {ks} ORDER BY seq) AS k
              FROM {src} WHERE sig <> 0),
    fold({ks}, k, seq, ts, sig, price, closed, opened, cash, pos) AS (
        SELECT {ks}, k, seq, ts, sig, price, {', '.join(first[c] for c in cols)} FROM sr WHERE k = 1
        UNION ALL
        SELECT {', '.join('s.' + k for k in keys)}, s.k, s.seq, s.ts, s.sig, s.price,
               {', '.join(nxt[c] for c in cols)}
        FROM fold f JOIN sr s ON {on} AND s.k = f.k + 1)"""


def final_select(cash0: float, keys=("symbol",), src: str = "frame") -> str:
    ks = ", ".join(keys)
    cash = f"coalesce(s.cash, {dbl(cash0)})"
    pos = "coalesce(s.pos, CAST(0 AS BIGINT))"
    return f"""lastbar AS (SELECT {ks}, arg_max(close, seq) AS last_close, count(*) AS n_bars,
                          count(*) FILTER (WHERE sig <> 0) AS n_signals FROM {src} GROUP BY {ks}),
    laststate AS (SELECT {ks}, arg_max(cash, k) AS cash, arg_max(pos, k) AS pos,
                         count(*) FILTER (WHERE opened <> 0) AS n_opened FROM fold GROUP BY {ks}),
    fin AS (SELECT {', '.join('l.' + k for k in keys)}, n_bars, n_signals,
                   coalesce(n_opened, CAST(0 AS BIGINT)) AS n_opened, {cash} AS cash, {pos} AS pos, last_close,
                   {cash} + {pos} * last_close AS final_value
            FROM lastbar l LEFT JOIN laststate s USING ({ks}))"""


def equity_ctes(cash0: float) -> str:
    w = "(PARTITION BY symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""eqj AS (SELECT fr.*, f.cash AS fcash, f.pos AS fpos FROM frame fr
                      LEFT JOIN fold f ON f.symbol = fr.symbol AND f.seq = fr.seq),
    eq AS (SELECT *, coalesce(last_value(fcash IGNORE NULLS) OVER {w}, {dbl(cash0)}) AS cash,
                     coalesce(last_value(fpos IGNORE NULLS) OVER {w}, CAST(0 AS BIGINT)) AS pos
           FROM eqj)"""


# ---------------------------------------------------------------- queries
def _bars_q(frame: str) -> str:
    return f"SELECT symbol, ts, open, high, low, close, volume, n_ticks FROM ({bars_sql(frame)}) x"


def _strategy_ctes(name: str, halt: bool = False) -> tuple[str, float]:
    if name == "ema_hourly":
        return f"{series_ctes('E')}, {ema_frame_ctes(C.SHORT, C.LONG)}, {fold_ctes(C.CASH, halt)}", C.CASH
    if name == "sma_orders":
        return (f"{series_ctes('O')}, {sma_frame_ctes(C.SHORT, C.LONG)}, {fold_ctes(C.RSI_CASH, halt)}",
                C.RSI_CASH)
    if name == "sma":
        return f"{series_ctes('L')}, {sma_frame_ctes(C.SHORT, C.LONG)}, {fold_ctes(C.CASH, halt)}", C.CASH
    if name == "ema":
        return f"{series_ctes('L')}, {ema_frame_ctes(C.SHORT, C.LONG)}, {fold_ctes(C.CASH, halt)}", C.CASH
    if name == "rsi":
        return f"{series_ctes('O')}, {rsi_frame_ctes(C.RSI_N)}, {fold_ctes(C.RSI_CASH, halt)}", C.RSI_CASH
    raise ValueError(name)


def _final_q(name: str, halt: bool = False) -> str:
    ctes, cash0 = _strategy_ctes(name, halt)
    return f"""WITH RECURSIVE {ctes}, {final_select(cash0)}
    SELECT symbol, n_bars, n_signals, n_opened, {r2('cash')} AS cash, pos, last_close,
           {r2('final_value')} AS final_value FROM fin"""


def _equity_q(name: str) -> str:
    ctes, cash0 = _strategy_ctes(name)
    return f"""WITH RECURSIVE {ctes}, {equity_ctes(cash0)}
    SELECT symbol, ts, close, {r2('cash')} AS cash, pos, {r2('cash + pos * close')} AS equity FROM eq"""


def _signal_q(name: str) -> str:
    ctes, _ = _strategy_ctes(name)
    return f"WITH RECURSIVE {ctes} SELECT symbol, ts, sig FROM frame"


def _sweep_q() -> str:
    parts = []
    for i, (s, l_) in enumerate(C.SWEEP_PAIRS):
        parts.append(f"""f{i} AS (SELECT *, {i} AS param_id, {s} AS fast_period, {l_} AS slow_period,
                   {cross_expr('lag(fast) OVER w', 'lag(slow) OVER w', 'fast', 'slow')} AS sig
              FROM (SELECT *, {sma_expr(s)} AS fast, {sma_expr(l_)} AS slow FROM b) x
              WINDOW w AS (PARTITION BY symbol ORDER BY seq))""")
    union = " UNION ALL ".join(f"SELECT * FROM f{i}" for i in range(len(C.SWEEP_PAIRS)))
    keys = ("symbol", "param_id")
    return f"""WITH RECURSIVE {series_ctes('L')}, {', '.join(parts)},
    frame AS ({union}), {fold_ctes(C.CASH, False, keys)}, {final_select(C.CASH, keys)},
    periods AS (SELECT DISTINCT param_id, fast_period, slow_period FROM frame)
    SELECT symbol, fast_period, slow_period, n_signals, n_opened, {r2('final_value')} AS final_value
    FROM fin JOIN periods USING (param_id)"""


def _sweep_ema_q() -> str:
    spans = sorted({p for pair in C.SWEEP_PAIRS for p in pair})
    cols = ", ".join(f"e{p}" for p in spans)
    steps = ", ".join(ewm_step(f"e.e{p}", "b.close", 2.0 / (p + 1)) for p in spans)
    parts = []
    for i, (s, l_) in enumerate(C.SWEEP_PAIRS):
        parts.append(f"""f{i} AS (SELECT symbol, seq, ts, close, {i} AS param_id, {s} AS fast_period,
                   {l_} AS slow_period, e{s} AS fast, e{l_} AS slow,
                   {cross_expr(f'lag(e{s}) OVER w', f'lag(e{l_}) OVER w', f'e{s}', f'e{l_}')} AS sig
              FROM ind WINDOW w AS (PARTITION BY symbol ORDER BY seq))""")
    union = " UNION ALL ".join(f"SELECT * FROM f{i}" for i in range(len(C.SWEEP_PAIRS)))
    keys = ("symbol", "param_id")
    return f"""WITH RECURSIVE {series_ctes('L')},
    ema(symbol, seq, {cols}) AS (
        SELECT symbol, seq, {', '.join('close' for _ in spans)} FROM b WHERE seq = 0
        UNION ALL
        SELECT b.symbol, b.seq, {steps} FROM ema e JOIN b ON b.symbol = e.symbol AND b.seq = e.seq + 1),
    ind AS (SELECT b.*, {', '.join('e.e' + str(p) for p in spans)} FROM b JOIN ema e USING (symbol, seq)),
    {', '.join(parts)},
    frame AS ({union}), {fold_ctes(C.CASH, False, keys)}, {final_select(C.CASH, keys)},
    periods AS (SELECT DISTINCT param_id, fast_period, slow_period FROM frame)
    SELECT symbol, fast_period, slow_period, n_signals, n_opened, {r2('final_value')} AS final_value
    FROM fin JOIN periods USING (param_id)"""


def _sweep_rsi_q(frame: str = "O", cash: float | None = None) -> str:
    cash = C.RSI_CASH if cash is None else cash
    parts = [rsi_frame_ctes(n, f"_{n}") for n in C.RSI_SWEEP]
    union = " UNION ALL ".join(
        f"SELECT symbol, seq, ts, close, sig, {i} AS param_id, {n} AS rsi_period FROM frame_{n}"
        for i, n in enumerate(C.RSI_SWEEP))
    keys = ("symbol", "param_id")
    return f"""WITH RECURSIVE {series_ctes(frame)}, {', '.join(parts)},
    frame AS ({union}), {fold_ctes(cash, False, keys)}, {final_select(cash, keys)},
    periods AS (SELECT DISTINCT param_id, rsi_period FROM frame)
    SELECT symbol, rsi_period, n_signals, n_opened, {r2('final_value')} AS final_value
    FROM fin JOIN periods USING (param_id)"""


def _warmup_ctes(symbol: str | None = None) -> str:
    start, end = C.WARMUP
    end_ts = f"(CAST('{end}' AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND)"
    only = "" if symbol is None else f" AND symbol = '{symbol}'"
    return f"""{series_ctes('L')},
    lim AS (SELECT * FROM b WHERE ts <= {end_ts}{only}),
    firsts AS (SELECT symbol, min(seq) AS f FROM lim WHERE ts >= CAST('{start}' AS TIMESTAMP) GROUP BY symbol),
    win AS (SELECT symbol, ts, close, lim.seq - greatest(f - {C.LONG}, 0) AS seq,
                   ts >= CAST('{start}' AS TIMESTAMP) AS in_range
            FROM lim JOIN firsts USING (symbol) WHERE lim.seq >= greatest(f - {C.LONG}, 0)),
    {sma_frame_ctes(C.SHORT, C.LONG, 'win')}"""


def _range_run_q() -> str:
    return f"""WITH RECURSIVE {_warmup_ctes(C.SCAN[0])},
    tr AS (SELECT * FROM frame WHERE in_range), {fold_ctes(C.CASH, src='tr')}, {final_select(C.CASH, src='tr')}
    SELECT symbol, n_bars, n_signals, n_opened, {r2('cash')} AS cash, pos, last_close,
           {r2('final_value')} AS final_value FROM fin"""


def _warmup_q() -> str:
    return f"""WITH RECURSIVE {_warmup_ctes()}
    SELECT symbol, ts, close, {r6('fast')} AS fast, {r6('slow')} AS slow, sig FROM frame WHERE in_range"""


def _ema_gaps_q() -> str:
    """EMA over closes blanked at every GAP_EVERY-th bar; one missing close lies between two values at most."""
    def step(y: str, alpha: float) -> str:
        a = 1.0 / (1.0 + (1.0 - alpha) / alpha)
        w = f"CASE WHEN (b.seq - 1) % {C.GAP_EVERY} = 0 THEN {dbl((1.0 - a) ** 2)} ELSE {dbl(1.0 - a)} END"
        return (f"CASE WHEN b.seq % {C.GAP_EVERY} = 0 THEN {y} WHEN {y} IS NULL THEN b.close "
                f"ELSE (({w}) * {y} + {dbl(a)} * b.close) / (({w}) + {dbl(a)}) END")

    return f"""WITH RECURSIVE {series_ctes('L')},
    ema(symbol, seq, fast, slow) AS (
        SELECT symbol, seq, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM b WHERE seq = 0
        UNION ALL
        SELECT b.symbol, b.seq, {step('e.fast', 2.0 / (C.SHORT + 1))}, {step('e.slow', 2.0 / (C.LONG + 1))}
        FROM ema e JOIN b ON b.symbol = e.symbol AND b.seq = e.seq + 1)
    SELECT symbol, ts, CASE WHEN seq % {C.GAP_EVERY} <> 0 THEN close END AS close,
           {r6('e.fast')} AS fast, {r6('e.slow')} AS slow FROM b JOIN ema e USING (symbol, seq)"""


def _ema_gap_runs_q() -> str:
    """EMA over closes of which each block of GAP_BLOCK bars misses the first 2 to LONGEST_GAP."""
    run = f"(2 + (b.seq // {C.GAP_BLOCK}) % {C.LONGEST_GAP - 1})"
    at = f"(b.seq % {C.GAP_BLOCK})"

    def step(y: str, alpha: float) -> str:
        a = 1.0 / (1.0 + (1.0 - alpha) / alpha)
        w = f"pow({dbl(1.0 - a)}, CASE WHEN {at} = {run} THEN {run} + 1 ELSE 1 END)"
        return f"CASE WHEN {at} < {run} THEN {y} WHEN {y} IS NULL THEN b.close ELSE (({w}) * {y} + {dbl(a)} * b.close) / (({w}) + {dbl(a)}) END"

    return f"""WITH RECURSIVE {series_ctes('L')},
    ema(symbol, seq, fast, slow) AS (
        SELECT symbol, seq, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM b WHERE seq = 0
        UNION ALL
        SELECT b.symbol, b.seq, {step('e.fast', 2.0 / (C.SHORT + 1))}, {step('e.slow', 2.0 / (C.LONG + 1))}
        FROM ema e JOIN b ON b.symbol = e.symbol AND b.seq = e.seq + 1)
    SELECT symbol, ts, CASE WHEN {at} >= {run} THEN close END AS close,
           {r6('e.fast')} AS fast, {r6('e.slow')} AS slow FROM b JOIN ema e USING (symbol, seq)"""


def _batch_rows_q() -> str:
    """Equal spans of time, as many as a replay of few rows has."""
    from barflow.streaming.replay import LEAST_SLICES as n

    return f"""WITH t AS (SELECT epoch_us(ts) AS us FROM ({bars_sql('L')}) x), lim AS (SELECT min(us) AS lo, max(us) AS hi FROM t)
    SELECT CAST(least((us - lo) // greatest(1, (hi - lo) // {n} + 1), {n - 1}) AS BIGINT) AS batch_id, count(*) AS n_rows
    FROM t, lim GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    sym, lo, hi = C.SCAN
    q: dict[str, str] = {
        "bars_daily": _bars_q("L"),
        "bars_hourly": _bars_q("E"),
        "bars_orders": _bars_q("O"),
        "scan_range": f"""SELECT * FROM ({_bars_q('L')}) x WHERE symbol = '{sym}'
            AND ts >= CAST('{lo}' AS TIMESTAMP) AND ts < CAST('{hi}' AS TIMESTAMP) + INTERVAL 1 DAY""",
        "bar_table": f"""SELECT * FROM ({_bars_q('L')}) x WHERE symbol IN ({', '.join(repr(v) for v in C.TABLE_SCAN[0])})
            AND ts >= CAST('{C.TABLE_SCAN[1]}' AS TIMESTAMP)
            AND ts < CAST('{C.TABLE_SCAN[2]}' AS TIMESTAMP) + INTERVAL 1 DAY""",
        "json_roundtrip": f"SELECT symbol, ts, open, high, low, close, volume FROM ({bars_sql('L')}) x",
        "dedupe": f"SELECT DISTINCT symbol, ts, open, high, low, close, volume FROM ({bars_sql('L')}) x",
        "sma": f"""WITH {series_ctes('L')} SELECT symbol, ts, close, {r6(sma_expr(C.SHORT))} AS fast,
            {r6(sma_expr(C.LONG))} AS slow FROM b""",
        "price_change": f"""WITH {series_ctes('O')}, {gains_ctes(C.RSI_N)}
            SELECT symbol, ts, close, {r2('price_change')} AS price_change FROM rg""",
        "gain_loss": f"""WITH {series_ctes('O')}, {gains_ctes(C.RSI_N)}
            SELECT symbol, ts, {r2('gain')} AS gain, {r2('loss')} AS loss FROM rg""",
        "rolling_gain_loss": f"""WITH {series_ctes('O')}, {gains_ctes(C.RSI_N)}
            SELECT symbol, ts, {r6('rolling_gain')} AS rolling_gain, {r6('rolling_loss')} AS rolling_loss FROM rg""",
        "ema": f"""WITH RECURSIVE {series_ctes('L')}, {ema_frame_ctes(C.SHORT, C.LONG)}
            SELECT symbol, ts, close, {r6('fast')} AS fast, {r6('slow')} AS slow FROM frame""",
        "wilder": f"""WITH RECURSIVE {series_ctes('O')}, {rsi_frame_ctes(C.RSI_N)}
            SELECT symbol, ts, {r6('avg_gain')} AS avg_gain, {r6('avg_loss')} AS avg_loss FROM frame""",
        "rsi": f"""WITH RECURSIVE {series_ctes('O')}, {rsi_frame_ctes(C.RSI_N)}
            SELECT symbol, ts, close, {r6('rsi')} AS rsi FROM frame""",
        "signal_sma": _signal_q("sma"),
        "signal_ema": _signal_q("ema"),
        "signal_rsi": _signal_q("rsi"),
        "final_sma": _final_q("sma"),
        "final_sma_halt": _final_q("sma", halt=True),
        "final_ema": _final_q("ema"),
        "final_rsi": _final_q("rsi"),
        "trades_sma": f"""WITH RECURSIVE {_strategy_ctes('sma')[0]}
            SELECT symbol, ts, sig, price, closed, opened, {r2('cash')} AS cash, pos FROM fold""",
        "equity_sma": _equity_q("sma"),
        "equity_ema": _equity_q("ema"),
        "equity_rsi": _equity_q("rsi"),
        "warmup_sma": _warmup_q(),
        "range_run": _range_run_q(),
        "sweep_sma": _sweep_q(),
        "sweep_ema": _sweep_ema_q(),
        "sweep_rsi": _sweep_rsi_q(),
        "sweep_all": f"""SELECT symbol, 'sma' AS strategy, fast_period AS param_a, slow_period AS param_b,
                   n_signals, n_opened, final_value FROM ({_sweep_q()}) s1
            UNION ALL SELECT symbol, 'ema', fast_period, slow_period, n_signals, n_opened, final_value
                   FROM ({_sweep_ema_q()}) s2
            UNION ALL SELECT symbol, 'rsi', rsi_period, 0, n_signals, n_opened, final_value
                   FROM ({_sweep_rsi_q('L', C.CASH)}) s3""",
        "chart_frame": f"""WITH RECURSIVE {_strategy_ctes('sma')[0]}, {equity_ctes(C.CASH)}
            SELECT symbol, ts, open, high, low, close, {r6('fast')} AS fast, {r6('slow')} AS slow, sig,
                   {r2('cash + pos * close')} AS equity FROM eq""",
        "summary": f"""WITH RECURSIVE {_strategy_ctes('sma')[0]}, {final_select(C.CASH)}
            SELECT symbol, 'sma' AS strategy, n_signals, n_opened, {r2('final_value')} AS final_value,
                   printf('Ending cash: $%.2f', {r2('final_value')}) AS text FROM fin""",
    }
    q["bars_stream_hourly"] = q["bars_hourly"]
    q["final_ema_hourly"] = _final_q("ema_hourly")
    q["final_sma_orders"] = _final_q("sma_orders")
    q["replay_sma"] = q["final_sma"]
    q["custom_ema"] = q["equity_ema"]
    q["stream_ema"] = q["equity_ema"]
    q["stream_sma"] = q["equity_sma"]
    q["stream_rsi"] = q["equity_rsi"]
    q["sma_chunked"] = q["sma"]
    q["ema_scan"] = q["ema"]
    q["wilder_scan"] = q["wilder"]
    q["equity_chunked"] = q["equity_sma"]
    q["ema_gaps"] = q["ema_gaps_chunked"] = _ema_gaps_q()
    q["stream_dedupe"] = q["upstream_fields"] = q["trigger_bars"] = q["dedupe"]
    q["custom_sma_chunked"] = q["equity_sma"]
    q["custom_rsi"] = q["equity_rsi"]
    q["stream_warmup_sma"] = q["warmup_sma"]
    q["range_run_table"] = q["range_run"]
    q["snapshot_sma"] = q["final_sma"]
    q["live_view_bars"] = f"""SELECT symbol, count(*) AS n_bars, min(low) AS low, max(high) AS high, CAST(sum(volume) AS BIGINT) AS volume
        FROM ({bars_sql('L')}) x GROUP BY symbol"""
    q["batch_rows"] = _batch_rows_q()
    q["dead_letters"] = f"""SELECT symbol, count(*) AS n_dead, count(*) FILTER (WHERE day(ts) = {C.CUT_DAY}) AS n_unread,
        count(*) FILTER (WHERE day(ts) = {C.ZERO_DAY}) AS n_bad_close FROM ({bars_sql('L')}) x
        WHERE day(ts) IN ({C.CUT_DAY}, {C.ZERO_DAY}) GROUP BY symbol"""
    q["json_millis"] = f"""SELECT symbol, ts + to_milliseconds(volume % 1000) AS ts, open, high, low, close, volume
        FROM ({bars_sql('L')}) x"""
    q["ema_gap_runs"] = q["ema_gap_runs_chunked"] = _ema_gap_runs_q()
    return q
