"""Whole analyses composed from the operators."""

from logstats.plans.report import (
    final_events,
    machine_report,
    report_stage_counts,
    stepwise_report,
)
from logstats.plans.job import read_log, run_report

__all__ = [
    "final_events",
    "machine_report",
    "read_log",
    "report_stage_counts",
    "run_report",
    "stepwise_report",
]
