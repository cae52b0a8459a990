"""Split by day: only the days that are missing are added; scans, day bounds and day passes."""

import datetime as dt

from pyspark.sql import functions as F

from homeshift.config import FIXTURE_THRESHOLDS as TH
from homeshift.operators import confirm as cf
from homeshift.operators import streak as sk
from homeshift.session import scratch_path
from homeshift.sources import calendar as cal
from homeshift.sources import sinks
from homeshift.sources import tables as tb
from places import SF_SMALL


def test_rerun_adds_the_new_days_and_leaves_the_old_ones(spark):
    v = tb.visits(spark, SF_SMALL)
    path = scratch_path(spark, "split")
    first = sinks.split_by_day(spark, v.where("date < DATE'2024-01-10'"), "date", "x", path).count()
    again = sinks.split_by_day(spark, v, "date", "x", path)
    assert (first < 809, again.count()) == (True, 809)
    doubled = v.withColumn("nb_hits", F.col("nb_hits") * 2)
    assert sorted(sinks.split_by_day(spark, doubled, "date", "x", path).collect()) == sorted(v.select(*v.columns).collect())


def test_available_days_without_and_with_cap(spark):
    days = cal.present_days(tb.visits(spark, SF_SMALL)).persist()
    assert (cal.available_days(days).count(), cal.available_days(days, cap=20).count()) == (28, 21)
    newest = [r["day_compact"] for r in cal.available_days(days, cap=1).orderBy("pos").collect()]
    assert newest == ["20240127", "20240128"]  # the two newest of the window, oldest first
    days.unpersist()


def test_scan_days_bounds(spark):
    v = tb.visits(spark, SF_SMALL)
    days = tb.scan_days(v, dt.date(2024, 1, 3), dt.date(2024, 1, 4)).select("date").distinct()
    assert sorted(r[0].day for r in days.collect()) == [3, 4]


def test_day_pass_branches(spark):
    d = dt.date(2024, 1, 20)
    old = dt.date(2024, 1, 14)
    feed = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "user_id long, zipcode string")
    streak = spark.createDataFrame([(2, "a", old, 0, 3, 0), (3, "a", old, 1, 2, 0), (4, "c", old, 1, 4, 0)], "user_id long, zipcode string, streak_start date, weekend_days long, weekday_days long, week_no int")
    pool = spark.createDataFrame([(3, "b", 0, old), (4, "c", 0, old)], "user_id long, zipcode string, confirmed_week int, since date")
    got = sorted(map(tuple, sk.streak_merge(feed, streak, d).collect()))
    assert got == [(1, "a", d, 1, 0, 0), (2, "a", old, 1, 3, 1), (3, "b", d, 1, 0, 0), (4, "c", old, 1, 4, 0)]
    pools = sorted(map(tuple, sk.pool_merge(feed, streak, pool, d).collect()))
    assert pools == [(1, "a", 0, d), (3, "b", 0, old), (4, "c", 0, old)]


def test_week_totals_cover_the_whole_week(spark):
    """A user with two streak rows of one week: the anniversary row is measured against both rows' days."""
    d = dt.date(2024, 1, 14)
    rows = [(1, "a", dt.date(2024, 1, 8), 2, 3, 1), (1, "b", dt.date(2024, 1, 6), 2, 4, 1)]
    streak = spark.createDataFrame(rows, "user_id long, zipcode string, streak_start date, weekend_days long, weekday_days long, week_no int")
    assert cf.week_confirmed(streak, d, TH).count() == 0  # 3 of 7 weekdays: below the share of 0.6
    assert cf.week_confirmed(streak.where("zipcode = 'a'"), d, TH).count() == 1


def test_overwrite_replaces_and_error_keeps(spark):
    import pytest

    path = scratch_path(spark, "table")
    v = tb.visits(spark, SF_SMALL)
    sinks.write_table(v, path)
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_table(v, path)
    assert spark.read.parquet(path).count() == 809
    sinks.write_table(v.where("date = DATE'2024-01-02'"), path, mode="overwrite")
    assert spark.read.parquet(path).select("date").distinct().count() == 1
