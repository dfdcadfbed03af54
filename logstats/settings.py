"""Parameters of the analysis and the column groups the operators agree on."""

from __future__ import annotations

from dataclasses import dataclass

# A machine, as the metrics see it.
UNIT = ("system_id", "sw_rev", "config")
EXAM = (*UNIT, "exam_id")
# Total order of a machine's rows: tick, then sequence number, then the row's own key.
ORDER = ("tick", "seq", "event_key")

# Largest number of rows of one ordered group that a single task may scan.
MAX_GROUP_ROWS = 2_000_000

# Configuration and revision of a log that does not say them.
CONFIG = "MR750W"
SOFTWARE_REV = "DV25.0_R02_1549.b"

MODES = ("intended", "literal")


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


@dataclass(frozen=True)
class Settings:
    # Time limits in seconds and the message codes with a meaning of their own.
    service_gap_s: float = 5.0
    max_exam_s: float = 10800.0
    min_exam_s: float = 180.0
    exam_code: str = "2218714"
    reset_code: str = "2227557"
    shutdown_codes: tuple[str, ...] = ("200002352",)
    crash_codes: tuple[str, ...] = ("200002364",)
    # "code" counts rows with exam_code, "segment" counts the exams cut from the log.
    num_exams_by: str = "code"
    max_group_rows: int = MAX_GROUP_ROWS

    def __post_init__(self) -> None:
        if self.num_exams_by not in ("code", "segment"):
            raise ValueError("num_exams_by must be 'code' or 'segment'")


DEFAULTS = Settings()
