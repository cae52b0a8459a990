"""Invariants of the whole run at sf0.01, and the golden counts of §5.3."""

import pytest
from pyspark.sql import functions as F

from homeshift.config import FIXTURE_THRESHOLDS as TH
from homeshift.operators import home_zip as hz
from homeshift.plans.movers import MoverRun
from homeshift.sources import tables as tb
from places import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def run(spark):
    dhz = hz.daily_home_zip(tb.visits(spark, SF_MID))
    return MoverRun(dhz, TH, horizon=tb.last_day(spark, SF_MID))


def test_one_home_zip_per_user_day(run):
    assert run.dhz.groupBy("user_id", "day").count().where("count > 1").count() == 0


def test_one_reference_and_one_streak_per_user(run):
    assert run.reference.groupBy("user_id").count().where("count > 1").count() == 0
    assert run.streak.groupBy("user_id").count().where("count > 1").count() == 0


def test_streak_users_are_pool_users(run):
    s = run.streak.select("user_id").distinct()
    p = run.pool.select("user_id").distinct()
    assert s.join(p, "user_id", "left_anti").count() == 0
    assert p.join(s, "user_id", "left_anti").count() == 0


def test_week_number_never_ahead_of_age(run):
    h = run.horizon
    bad = run.streak.where(F.col("week_no") > F.floor((F.datediff(h, "streak_start") + 1) / 7))
    assert bad.count() == 0


def test_no_pool_user_older_than_limit(run):
    age = run.pool.groupBy("user_id").agg(F.min("since").alias("first"))
    assert age.where(F.datediff(run.horizon, "first") + 1 > TH.age_limit).count() == 0


def test_golden_counts_sf001(run):
    weeks = dict(run.pool.groupBy("confirmed_week").count().collect())
    assert (run.dhz.count(), run.reference.count(), run.history.count()) == (3213, 150, 210)
    assert (run.streak.count(), run.pool.count(), weeks) == (83, 231, {0: 197, 1: 23, 2: 11})
    assert run.evictions.where("reason = 'returned'").count() == 47
    assert run.potential_movers.select("user_id").distinct().count() == 37
    assert (run.potential_movers.count(), run.moves.count()) == (98, 23)


def test_golden_counts_sf0001(spark):
    r = MoverRun(hz.daily_home_zip(tb.visits(spark, SF_SMALL)), TH)
    assert (r.dhz.count(), r.streak.count(), r.pool.count(), r.moves.count()) == (323, 11, 30, 2)
