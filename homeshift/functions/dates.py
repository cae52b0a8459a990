"""Day arithmetic and labels as built-in Column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of weekend / working days, and of the home hours.
WEEKEND_LABEL = "we"
WEEKDAY_LABEL = "sem"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_weekend(day) -> Column:
    """Saturday or Sunday (Spark's dayofweek: 1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(_c(day)).isin(1, 7)


def weekend_label(day) -> Column:
    return F.when(is_weekend(day), F.lit(WEEKEND_LABEL)).otherwise(F.lit(WEEKDAY_LABEL))


def weekday_name(day) -> Column:
    """English day name, e.g. 'Sunday' for 2017-06-11."""
    return F.date_format(_c(day), "EEEE")


def parse_day(s) -> Column:
    """A day given as 'yyyy-MM-dd' or 'yyyyMMdd' text."""
    s = _c(s)
    return F.when(s.contains("-"), F.try_to_date(s, "yyyy-MM-dd")).otherwise(
        F.try_to_date(s, "yyyyMMdd")
    )


def compact_day(day) -> Column:
    """DATE -> 'yyyyMMdd'."""
    return F.date_format(_c(day), "yyyyMMdd")


def format_day(compact, sep: str = "-") -> Column:
    """'yyyyMMdd' -> 'yyyy<sep>MM<sep>dd' by slicing, like the text helper."""
    s = _c(compact)
    return F.concat_ws(sep, F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))


def day_before(compact, n: int) -> Column:
    """'yyyyMMdd' n days earlier, as 'yyyyMMdd'."""
    return compact_day(F.date_sub(F.to_date(_c(compact), "yyyyMMdd"), n))


def inclusive_day_diff(end, start) -> Column:
    """Number of days from start to end, both counted."""
    return F.datediff(_c(end), _c(start)) + 1


def elapsed_weeks(end, start) -> Column:
    """Whole weeks in the inclusive day count (truncating division by 7)."""
    return F.floor(inclusive_day_diff(end, start) / 7).cast("int")


def weekend_flag(day) -> Column:
    return is_weekend(day).cast("int")


def weekday_flag(day) -> Column:
    return (~is_weekend(day)).cast("int")
