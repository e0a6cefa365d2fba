"""barflow: trading strategies over OHLCV bars as Spark DataFrame plans.

Layout:
  sources/    tick frames from tables, JSON bar codec, range scan, bar stream source
  operators/  bars from ticks, sequence index and chunking, indicators, signals, ledger
  functions/  column-expression helpers (rounding, sizing, RSI formula, crossing rules)
  plans/      strategies, parameter sweep, report frames, the named query catalog
  streaming/  replay, sinks, run control, per-symbol stateful strategy
"""

__version__ = "0.1.0"

import sys as _sys

try:  # ship barflow's functions with each task: executors need not install it
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark without the hook
    pass
