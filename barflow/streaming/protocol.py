"""The per-bar strategy interface.

A strategy keeps a small state and consumes one bar at a time:

    state = strategy.init_state()
    state, row = strategy.next(state, close)   # row: indicator values + sig

    state, columns, sig = strategy.block(state, closes)   # the same for many bars, as arrays

``block`` may be left out (``run_block`` then steps bar by bar). ``lookback`` is the number of
bars after which the start of a series no longer shows (None: never), ``fixed`` the number of
leading state entries that are not a window of past closes.

The arithmetic mirrors the batch operators step for step (same sums in the
same order, the same exponential update), so a stream and a batch run agree.
State is a flat list of floats so it fits a fixed state schema.
"""

from __future__ import annotations

import math
from typing import Protocol

import numpy as np
import pandas as pd

from barflow.operators.recurrence import halo_rows
from barflow.schema import RSI_HIGH, RSI_LOW

NAN = float("nan")


def _isnan(x) -> bool:
    return x is None or (isinstance(x, float) and math.isnan(x))


def _cross(pf, ps, f, s) -> int:
    if _isnan(pf) or _isnan(ps) or _isnan(f) or _isnan(s):
        return 0
    if pf <= ps and f > s:
        return 1
    if pf >= ps and f < s:
        return -1
    return 0


def ewm_alpha(alpha: float) -> float:
    """The weight pandas' ewm(alpha=..., adjust=False) ends up using."""
    return 1.0 / (1.0 + (1.0 - alpha) / alpha)


def ewm_next(prev: float, x: float, a: float, gap: float = 0.0) -> float:
    """The next mean; ``gap`` missing values since the last one decay the carried weight."""
    if _isnan(x):
        return prev
    if _isnan(prev) or prev == x:
        return x
    kept = (1.0 - a) ** (gap + 1)
    return (kept * prev + a * x) / (kept + a)


def _period(n) -> int:
    if int(n) != n or n < 1:
        raise ValueError(f"period must be an integer >= 1, got {n}")
    return int(n)


def cross_block(pf: np.ndarray, ps: np.ndarray, f: np.ndarray, s: np.ndarray) -> np.ndarray:
    """``_cross`` on arrays; a comparison with a missing value is false."""
    return ((pf <= ps) & (f > s)).astype(np.int64) - ((pf >= ps) & (f < s)).astype(np.int64)


def ewm_block(prev: float, gap: float, x: np.ndarray, alpha: float) -> np.ndarray:
    """The means after each of ``x``, from a mean and the missing values since; ``alpha`` as given to ``ewm``."""
    lead = [] if _isnan(prev) else [prev, *[NAN] * int(gap)]
    return pd.Series(np.append(lead, x)).ewm(alpha=alpha, adjust=False).mean().to_numpy()[len(lead):]


def gap_after(gap: float, x: np.ndarray) -> float:
    """Missing values at the end of ``x``, which go on from ``gap`` if there are no others."""
    found = np.flatnonzero(~np.isnan(x))
    return float(len(x) - 1 - found[-1]) if len(found) else gap + len(x)


def shifted(first: float, x: np.ndarray) -> np.ndarray:
    return np.append(first, x[:-1])


def run_block(strategy: BarStrategy, state: list[float], closes: np.ndarray) -> tuple[list[float], dict[str, np.ndarray], np.ndarray]:
    """``strategy.block``, or ``next`` for each close of a strategy that has none."""
    if hasattr(strategy, "block"):
        return strategy.block(state, closes)
    columns: dict[str, list] = {c: [] for c in strategy.columns}
    sigs = []
    for close in closes.tolist():
        state, row = strategy.next(state, close)
        for c in strategy.columns:
            columns[c].append(NAN if row[c] is None else row[c])
        sigs.append(int(row["sig"]))
    return state, {c: np.array(v, dtype=np.float64) for c, v in columns.items()}, np.array(sigs, dtype=np.int64)


class BarStrategy(Protocol):
    name: str
    columns: tuple[str, ...]

    def init_state(self) -> list[float]: ...

    def next(self, state: list[float], close: float) -> tuple[list[float], dict]: ...


class SmaCross:
    """State: [n, prev_fast, prev_slow, last `long` closes...]."""

    name = "sma"
    columns = ("fast", "slow")

    fixed = 3

    def __init__(self, short_period: int, long_period: int):
        self.s, self.l = _period(short_period), _period(long_period)
        self.keep = max(self.s, self.l)
        self.lookback = self.keep + 1

    def init_state(self):
        return [0.0, NAN, NAN]

    def _mean(self, window, n):
        if len(window) < n:
            return NAN
        total = 0.0
        for v in window[-n:]:
            total += v
        return total / n

    def next(self, state, close):
        n, pf, ps, ring = state[0], state[1], state[2], list(state[3:])
        ring.append(close)
        ring = ring[-self.keep:]
        f, s = self._mean(ring, self.s), self._mean(ring, self.l)
        sig = _cross(pf, ps, f, s)
        return [n + 1, f, s, *ring], {"fast": f, "slow": s, "sig": sig}

    def block(self, state, closes):
        every = np.append(state[3:], closes)
        held, m = len(state) - 3, len(closes)
        means = []
        for n in (self.s, self.l):
            total = np.zeros(max(len(every) - n + 1, 0))
            for k in range(n):  # oldest first, as the window of one bar is summed
                total += every[k:k + len(total)]
            mean = np.append(np.full(len(every) - len(total), NAN), total / n)
            means.append(mean[held:])
        f, s = means
        sig = cross_block(shifted(state[1], f), shifted(state[2], s), f, s)
        return [state[0] + m, float(f[-1]), float(s[-1]), *every[-self.keep:].tolist()], {"fast": f, "slow": s}, sig


class EmaCross:
    """State: [n, fast, slow, missing closes since the last one]."""

    name = "ema"
    columns = ("fast", "slow")

    fixed = 4

    def __init__(self, short_period: int, long_period: int):
        self.alphas = [2.0 / (_period(p) + 1) for p in (short_period, long_period)]
        self.lookback = max(halo_rows(a) for a in self.alphas) + 1
        self.a1 = ewm_alpha(2.0 / (_period(short_period) + 1))
        self.a2 = ewm_alpha(2.0 / (_period(long_period) + 1))

    def init_state(self):
        return [0.0, NAN, NAN, 0.0]

    def next(self, state, close):
        n, pf, ps, gap = state
        f, s = ewm_next(pf, close, self.a1, gap), ewm_next(ps, close, self.a2, gap)
        sig = _cross(pf, ps, f, s)
        return [n + 1, f, s, gap + 1 if _isnan(close) else 0.0], {"fast": f, "slow": s, "sig": sig}

    def block(self, state, closes):
        n, pf, ps, gap = state
        f, s = (ewm_block(prev, gap, closes, a) for prev, a in zip((pf, ps), self.alphas, strict=True))
        sig = cross_block(shifted(pf, f), shifted(ps, s), f, s)
        return [n + len(closes), float(f[-1]), float(s[-1]), gap_after(gap, closes)], {"fast": f, "slow": s}, sig


class RsiThreshold:
    """State: [n, last_close, avg_gain, avg_loss, prev_rsi, missing changes since the last one,
    last n gains..., last n losses...]."""

    name = "rsi"
    columns = ("rsi",)
    fixed = 6
    lookback = None  # the first rows of a series are the seed

    def __init__(self, period: int, low: float = RSI_LOW, high: float = RSI_HIGH):
        self.n = _period(period)
        self.a = ewm_alpha(1.0 / self.n)
        self.low, self.high = low, high

    def init_state(self):
        return [0.0, NAN, NAN, NAN, NAN, 0.0]

    @staticmethod
    def _rsi(g, l_):
        if _isnan(g) or _isnan(l_):
            return NAN
        if l_ == 0:
            return NAN if g == 0 else 100.0
        return 100.0 - 100.0 / (1.0 + g / l_)

    def next(self, state, close):
        n, last, ag, al, prev_rsi, gap = state[:6]
        hist = state[6:]
        gains, losses = list(hist[: len(hist) // 2]), list(hist[len(hist) // 2:])
        seq = int(n)
        if seq > 0:
            d = close - last
            g, l_ = (NAN, NAN) if _isnan(d) else (max(d, 0.0), max(-d, 0.0))
            if seq <= self.n:
                gains.append(g)
                losses.append(l_)
            if seq == self.n:
                tg = tl = 0.0
                for v in gains:
                    tg += v
                for v in losses:
                    tl += v
                ag, al = tg / self.n, tl / self.n
                gains, losses, gap = [], [], 0.0
            elif seq > self.n:
                ag, al = ewm_next(ag, g, self.a, gap), ewm_next(al, l_, self.a, gap)
                gap = gap + 1 if _isnan(g) else 0.0
        rsi = self._rsi(ag, al)
        sig = 0
        if not (_isnan(prev_rsi) or _isnan(rsi)):
            if prev_rsi <= self.low and rsi > self.low:
                sig = 1
            elif prev_rsi >= self.high and rsi < self.high:
                sig = -1
        return [n + 1, close, ag, al, rsi, gap, *gains, *losses], {"rsi": rsi, "sig": sig}

    def block(self, state, closes):
        first = min(max(self.n + 1 - int(state[0]), 0), len(closes))  # rows until the seed is complete
        rsis, sigs = np.empty(len(closes)), np.zeros(len(closes), dtype=np.int64)
        for i, close in enumerate(closes[:first].tolist()):
            state, row = self.next(state, close)
            rsis[i], sigs[i] = row["rsi"], row["sig"]
        rest = closes[first:]
        if len(rest):
            n, last, ag, al, prev_rsi, gap = state[:6]
            change = rest - shifted(last, rest)
            gains, losses = np.where(np.isnan(change), NAN, np.maximum(change, 0.0)), np.where(np.isnan(change), NAN, np.maximum(-change, 0.0))
            g, l_ = (ewm_block(prev, gap, x, 1.0 / self.n) for prev, x in ((ag, gains), (al, losses)))
            with np.errstate(divide="ignore", invalid="ignore"):
                rsi = np.where(l_ == 0, np.where(g == 0, NAN, 100.0), 100.0 - 100.0 / (1.0 + g / l_))
            rsi[np.isnan(g) | np.isnan(l_)] = NAN
            before = shifted(prev_rsi, rsi)
            rsis[first:] = rsi
            sigs[first:] = ((before <= self.low) & (rsi > self.low)).astype(np.int64) - ((before >= self.high) & (rsi < self.high)).astype(np.int64)
            state = [n + len(rest), float(rest[-1]), float(g[-1]), float(l_[-1]), float(rsi[-1]), gap_after(gap, gains)]
        return state, {"rsi": rsis}, sigs


def make_strategy(name: str, **params) -> BarStrategy:
    if name == "sma":
        return SmaCross(params["short_period"], params["long_period"])
    if name == "ema":
        return EmaCross(params["short_period"], params["long_period"])
    if name == "rsi":
        return RsiThreshold(params["rsi_period"])
    raise ValueError(f"unknown strategy {name!r}")
