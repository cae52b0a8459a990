"""Hand-made edge rows of the daily home zip (FIXTURES §4)."""

import datetime as dt

from homeshift.operators.home_zip import daily_home_zip
from homeshift.schemas import VISITS

TUE = dt.date(2024, 1, 16)
SUN = dt.date(2024, 1, 14)


def visits(spark, rows):
    return spark.createDataFrame(rows, VISITS)


def result(spark, rows):
    return sorted(tuple(r) for r in daily_home_zip(visits(spark, rows)).collect())


def test_tie_in_hits_takes_larger_zip(spark):
    rows = [("1", "75001", 2, TUE, 5), ("1", "75002", 3, TUE, 5)]
    assert result(spark, rows) == [(1, "75002", TUE)]


def test_duplicate_rows_counted_once(spark):
    rows = [("1", "75001", 2, TUE, 5), ("1", "75001", 2, TUE, 5), ("1", "75002", 2, TUE, 8)]
    assert result(spark, rows) == [(1, "75002", TUE)]


def test_bad_inputs_give_no_row(spark):
    rows = [
        ("x12", "75001", 2, TUE, 5),   # cookie not a number
        ("2", "7500", 2, TUE, 5),      # 4-character zip
        ("3", None, 2, TUE, 5),        # null zip
        ("4", "75004", None, TUE, 5),  # null time of day on a weekday
    ]
    assert result(spark, rows) == []


def test_weekday_needs_home_hours_weekend_does_not(spark):
    assert result(spark, [("5", "75005", 1, TUE, 9)]) == []
    assert result(spark, [("5", "75005", 1, SUN, 9)]) == [(5, "75005", SUN)]


def test_home_hours_beat_work_hours_on_weekdays(spark):
    rows = [("6", "75006", 1, TUE, 100), ("6", "75007", 3, TUE, 1)]
    assert result(spark, rows) == [(6, "75007", TUE)]
