from starloom.functions.columns import (
    MONEY,
    RATE,
    calendar_attributes,
    changed,
    date_key,
    default_zero,
    order_discount,
    pass_fail,
    snapshot_key,
    try_as,
)

__all__ = [
    "MONEY",
    "RATE",
    "calendar_attributes",
    "changed",
    "date_key",
    "default_zero",
    "order_discount",
    "pass_fail",
    "snapshot_key",
    "try_as",
]
