"""Time helpers on TIMESTAMP_NTZ columns; none depends on the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def window_start(c: str | Column, width: str) -> Column:
    """Start of the tumbling window. Rows whose time is NULL belong to no window and drop out."""
    return F.window(_col(c), width).getField("start")


def floor_second(c: str | Column) -> Column:
    """Drop the fraction of a second. A one-second window is plain integer arithmetic, unlike
    truncation, which goes through the session zone, or the SECOND field, which is a decimal."""
    return window_start(c, "1 second")


def id_date_of(c: str | Column) -> Column:
    """Calendar key YYYYMMDD as an integer."""
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def month_of(c: str | Column) -> Column:
    """Partition key YYYYMM as an integer."""
    c = _col(c)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def iso_weekday(c: str | Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(_col(c)) + 1


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole-second difference; fractions are cut off on each side first."""

    def second_of_day(c: Column) -> Column:
        return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)

    start, end = _col(start), _col(end)
    days = F.datediff(end, start).cast("long")
    return days * 86400 + second_of_day(end) - second_of_day(start)


def interval(text: str) -> Column:
    """Day-time interval such as ``5 minutes``."""
    amount, unit = text.split()
    unit = unit.rstrip("s").upper()
    if unit not in ("SECOND", "MINUTE", "HOUR", "DAY"):
        raise ValueError(f"unknown interval unit in {text!r}")
    return F.expr(f"INTERVAL '{int(amount)}' {unit}")


def timestamp(text: str) -> Column:
    """TIMESTAMP_NTZ literal."""
    return F.lit(str(text)).cast("timestamp_ntz")
