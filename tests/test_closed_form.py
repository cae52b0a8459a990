"""The home zip of copies, of a rollup, of events and of a hot cookie; the closed form without eviction."""

import datetime as dt

from pyspark.sql import functions as F

from homeshift.config import FIXTURE_THRESHOLDS as TH
from homeshift.operators import home_zip as hz
from homeshift.operators import reference as rf
from homeshift.operators import streak as sk
from homeshift.operators import user_state as us
from homeshift.plans.snapshot import NEVER
from homeshift.sources import tables as tb
from places import SF_MID


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_states_without_eviction_equal_the_windows(spark):
    """Islands over windows (no state machine) give the same references, streaks and pool rows."""
    dhz = hz.daily_home_zip_of_events(tb.table(spark, SF_MID, "events")).persist()
    states = us.replay(dhz, F.lit(dt.date(2024, 1, 30)), TH.with_(**NEVER)).persist()
    ann = rf.annotate(dhz, TH)
    assert rows(us.reference(states), "user_id", "reference_zip", "ref_day") == rows(rf.reference_zip(ann), "user_id", "reference_zip", "ref_day")
    assert rows(us.streak(states), *sk.STREAK_COLS) == rows(sk.mover_streak(ann), *sk.STREAK_COLS)
    assert rows(us.pool(states), *sk.POOL_COLS) == rows(sk.mover_pool(ann, TH), *sk.POOL_COLS)


def test_events_and_visits_give_the_same_home_zips(spark):
    ev = tb.table(spark, SF_MID, "events")
    assert sorted(hz.daily_home_zip_of_events(ev).collect()) == sorted(hz.daily_home_zip(tb.visits(spark, SF_MID)).collect())


def test_hot_cookie_is_spread_before_the_exchange_on_users(spark):
    """A cookie with a third of all rows and 100,000 zips: right row, and no task gets its rows."""
    day = dt.date(2024, 1, 16)
    hot = spark.range(300_000).select(F.lit("7").alias("cookie"), F.format_string("%05d", F.col("id") % 100_000).alias("zipcode"), F.lit(2).alias("tranche"), F.lit(day).alias("date"), (F.col("id") % 9973).alias("nb_hits"))
    rest = spark.range(600_000).select((F.col("id") % 5000 + 100).cast("string").alias("cookie"), F.format_string("%05d", F.col("id") % 90_000).alias("zipcode"), F.lit(3).alias("tranche"), F.lit(day).alias("date"), (F.col("id") % 7).alias("nb_hits"))
    v = hot.unionByName(rest)
    hits: dict[str, int] = {}
    for z, n in {(i % 100_000, i % 9973) for i in range(300_000)}:
        hits[f"{z:05d}"] = hits.get(f"{z:05d}", 0) + n
    best = max((n, z) for z, n in hits.items())
    assert [r["zipcode"] for r in hz.daily_home_zip(v).where("user_id = 7").collect()] == [best[1]]
    spread = hz.hits_per_user_zip(hz.home_rows(v, unique=True)).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    sizes = sorted(r["count"] for r in spread)
    assert sizes[-1] < 3 * sizes[len(sizes) // 2]
    # a task sends one candidate a user and day: the arg-max has its map-side step before the exchange
    plan = hz.daily_home_zip(v)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("max(struct") and "hashpartitioning(user_id" in plan


def test_copies_need_the_distinct_and_a_rollup_does_not(spark):
    v = tb.visits(spark, SF_MID)
    want = sorted(hz.daily_home_zip(v, unique=True).collect())
    assert sorted(hz.daily_home_zip(v.unionAll(v)).collect()) == want
    hot = v.where("cookie = '1'")
    assert sorted(hz.daily_home_zip(v.unionAll(hot).unionAll(hot)).collect()) == want
