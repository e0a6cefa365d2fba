from barflow.operators.bars import ohlcv_bars  # noqa: F401
from barflow.operators.sequence import ffill_last, home_rows, join_on, over_chunks, with_seq  # noqa: F401
