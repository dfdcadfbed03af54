"""Scalar expressions; all of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from logstats.settings import check_mode


# A decimal number with blanks around it, as a log may write a tick.
DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def parse_tick(text: Column) -> Column:
    """Epoch seconds as a finite double, or null where the text is no decimal number.

    Spark's cast also takes hexadecimal numbers, a Java type suffix (``1.5d``) and the words
    for infinity and NaN; a log tick may be none of these.
    """
    plain = F.regexp_replace(text, r"\s", "")
    number = F.when(text.rlike(DECIMAL), plain.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def event_day(tick: Column) -> Column:
    """UTC day of an epoch-seconds column as ``yyyyMMdd``, whatever the session zone."""
    days = F.floor(tick / 86400).try_cast("int")
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days), "yyyyMMdd")


def code_flag(code: Column, codes: Iterable[str]) -> Column:
    """1 where the code is one of ``codes``, else 0 (also for a null code)."""
    return F.when(code.isin(*codes), 1).otherwise(0)


def count_rows_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def ipte_rate(amount: Column, exams: Column) -> Column:
    """``amount`` per thousand exams; null where there are no exams."""
    return F.try_divide(amount.cast("double") * 1000.0, exams.cast("double"))


def sevone(incidents: Column, shutdowns: Column, mode: str = "intended") -> Column:
    """Incidents of an exam less one when it was shut down more than once.

    The literal rule returns the incidents unchanged on either side.
    """
    check_mode(mode)
    if mode == "literal":
        return incidents
    return F.when(shutdowns > 1, incidents - 1).otherwise(incidents)
