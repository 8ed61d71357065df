from cdclake.functions.columns import (
    as_day,
    case_flag,
    coalesce_zero,
    differs,
    event_day,
    on_day,
    op_rank,
    ratio,
    to_money_total,
    wire_to_lake,
)

__all__ = [
    "as_day",
    "case_flag",
    "coalesce_zero",
    "differs",
    "event_day",
    "on_day",
    "op_rank",
    "ratio",
    "to_money_total",
    "wire_to_lake",
]
