"""CSV readers and the report sink."""

from logstats.sources.readers import (
    good_rows,
    quarantined,
    read_code_actions,
    read_level_weights,
    read_machine_log,
    read_machine_log_lines,
    read_system_list,
)
from logstats.sources.sinks import publish_report, read_report, write_report

__all__ = [
    "good_rows",
    "publish_report",
    "quarantined",
    "read_code_actions",
    "read_level_weights",
    "read_machine_log",
    "read_machine_log_lines",
    "read_report",
    "read_system_list",
    "write_report",
]
