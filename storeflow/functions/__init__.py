from storeflow.functions.columns import (
    calendar,
    money_label,
    pct_label,
    sale_price,
    second_of,
    stamped,
    time_key,
    with_event_time,
)

__all__ = [
    "calendar",
    "money_label",
    "pct_label",
    "sale_price",
    "second_of",
    "stamped",
    "time_key",
    "with_event_time",
]
