"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full into Spark's no-op sink (no collect to the
driver). A small warm-up query runs first and is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from barflow.plans import catalog as C  # noqa: E402
from barflow.plans.sweep import sweep_sma  # noqa: E402
from barflow.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

HEADLINE = ["bars_daily", "bars_hourly", "sma", "ema", "rsi", "final_sma", "final_ema", "final_rsi",
            "equity_sma", "trades_sma", "chart_frame", "sweep_sma", "replay_sma", "stream_ema"]

# 50 (fast, slow) pairs for the sweep throughput number.
SWEEP_50 = [(f, s) for f in (2, 3, 5, 8, 10) for s in (12, 15, 20, 25, 30, 40, 50, 60, 80, 100)]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=max(4, CPUS))
    _run(C.q_final_sma(spark, "/root/testdata/sf0.001"))  # warm-up, untimed
    times: dict[str, float] = {}
    stream_batch_ms = None
    for name in HEADLINE:
        t0 = time.perf_counter()
        _run(C.QUERIES[name](spark, SF_DIR))
        times[name] = round(time.perf_counter() - t0, 3)
        if name == "stream_ema" and C.LAST_PROGRESS:
            ms = [p["durationMs"]["triggerExecution"] for p in C.LAST_PROGRESS]
            stream_batch_ms = round(sum(ms) / len(ms), 1)
    t0 = time.perf_counter()
    _run(sweep_sma(C.bars_L(spark, SF_DIR), SWEEP_50, C.CASH).final)
    times["sweep_sma_50"] = round(time.perf_counter() - t0, 3)
    n_bars = C.bars_L(spark, SF_DIR).count()
    n_ticks = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    n_bars_o = C.bars_O(spark, SF_DIR).count()
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_query_time", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""), "cpus": CPUS,
        "bars_L": n_bars, "ticks_L": n_ticks,
        "bars_daily_ticks_per_sec": round(n_ticks / times["bars_daily"], 1),
        "sma_bars_per_sec": round(n_bars / times["final_sma"], 1),
        "ema_bars_per_sec": round(n_bars / times["final_ema"], 1),
        "rsi_bars_per_sec": round(n_bars_o / times["final_rsi"], 1),
        "sweep50_bar_params_per_sec": round(n_bars * len(SWEEP_50) / times["sweep_sma_50"], 1),
        "stream_ema_batch_ms": stream_batch_ms,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
