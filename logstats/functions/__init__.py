"""Column expressions shared by the operators."""

from logstats.functions.columns import (
    code_flag,
    count_rows_where,
    event_day,
    ipte_rate,
    parse_tick,
    sevone,
)

__all__ = [
    "code_flag",
    "count_rows_where",
    "event_day",
    "ipte_rate",
    "parse_tick",
    "sevone",
]
