from barflow.functions.columns import (  # noqa: F401
    cross_signal, gain, loss, money_text, price_change, round_half_up, rsi_from_averages,
    threshold_signal,
)
