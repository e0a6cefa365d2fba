from barflow.sources.bar_table import read_bar_table, write_bar_table  # noqa: F401
from barflow.sources.codec import (  # noqa: F401
    decode_bars, encode_bars, normalise_ts, rename_bar_fields, split_quarantine,
)
from barflow.sources.scan import scan_bars, scan_bars_from_ticks  # noqa: F401
from barflow.sources.ticks import event_ticks, lineitem_ticks, order_ticks, read_table  # noqa: F401
