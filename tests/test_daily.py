"""The daily job: versions of changed users, merged on reading, equal the whole run; broken jobs; one-day operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from homeshift.config import FIXTURE_THRESHOLDS as TH
from homeshift.operators import confirm as cf
from homeshift.operators import home_zip as hz
from homeshift.operators import reference as rf
from homeshift.operators import streak as sk
from homeshift.operators import user_state as us
from homeshift.plans.daily import StateStore, main, run_days
from homeshift.plans.movers import MoverRun
from homeshift.session import scratch_path
from homeshift.sources import catalog_tables as ct
from homeshift.sources import small_files as sf
from homeshift.sources import tables as tb
from places import SF_SMALL

FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 30)
TABLES = ("pool", "streak", "history", "reference", "registry")


def days(a, b):
    return [a + dt.timedelta(days=i) for i in range((b - a).days + 1)]


def rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()))


@pytest.fixture(scope="module")
def dhz(spark):
    out = hz.daily_home_zip_of_events(tb.table(spark, SF_SMALL, "events")).persist()
    yield out
    out.unpersist()


@pytest.fixture
def two_buckets(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("limits", [(28, 12), (28, 148)])
def test_thirty_days_equal_the_whole_run(two_buckets, dhz, limits):
    spark = two_buckets
    th = TH.with_(return_limit=limits[0], age_limit=limits[1])
    store = StateStore(spark, scratch_path(spark, "daily"))
    run_days(store, dhz, days(FIRST, LAST), th, compact_every=100)
    run = MoverRun(dhz, th, horizon=LAST)
    for name in TABLES:
        whole = getattr(run, name)
        assert rows(getattr(store, name)(), *whole.columns) == rows(whole), name
    own = us.audits(store.versions()).select("user_id", "day", "kind", "presence_days").distinct()
    assert rows(own) == rows(run.evictions.select("user_id", "day", "reason", "presence_days"))
    # a version holds the users seen that day, and those whose pool age ran out
    seen = dict(dhz.groupBy("day").count().collect())
    sizes = dict(store.versions().groupBy("version").count().collect())
    aged = dict(run.evictions.where("reason = 'aged'").groupBy("day").count().collect())
    for v, d in zip(store.manifest["versions"], days(FIRST, LAST)):
        assert seen.get(d, 0) <= sizes.get(v, 0) <= seen.get(d, 0) + aged.get(d, 0)


def test_load_compact_sweep_and_attach(two_buckets, dhz):
    spark = two_buckets
    cut = dt.date(2024, 1, 25)
    path = scratch_path(spark, "daily")
    store = StateStore(spark, path)
    store.load(MoverRun(dhz, TH, horizon=cut).states, cut)
    run_days(store, dhz, days(FIRST, LAST), TH, compact_every=3)  # days up to the cut are left out
    assert len(store.manifest["versions"]) <= 3 and store.last_day == LAST
    want = rows(MoverRun(dhz, TH, horizon=LAST).pool)
    assert rows(store.pool()) == want
    assert store.sweep() and rows(store.pool()) == want
    ct.drop_table(spark, store.table)  # as in a session that has never seen the table
    assert rows(StateStore(spark, path).pool()) == want
    with pytest.raises(FileExistsError):
        store.advance(dhz, LAST, TH)
    with pytest.raises(FileExistsError):
        store.load(MoverRun(dhz, TH).states, LAST)


def test_a_job_that_broke_off_or_came_second_changes_nothing(two_buckets, dhz):
    spark = two_buckets
    path = scratch_path(spark, "daily")
    store = StateStore(spark, path)
    run_days(store, dhz, days(FIRST, dt.date(2024, 1, 8)), TH)
    before = rows(store.state().select("user_id", "ref_day", F.size("fed")))
    late = StateStore(spark, path)  # another job that starts from the same state
    store._write(store.changes(dhz, dt.date(2024, 1, 9), TH))  # written, never named
    assert rows(store.state().select("user_id", "ref_day", F.size("fed"))) == before
    store.advance(dhz, dt.date(2024, 1, 9), TH)
    with pytest.raises(FileExistsError):
        late.advance(dhz, dt.date(2024, 1, 9), TH)
    again = StateStore(spark, path)
    assert again.last_day == dt.date(2024, 1, 9)
    assert rows(again.history()) == rows(MoverRun(dhz, TH, horizon=dt.date(2024, 1, 9)).history)


def test_only_todays_rows_are_shuffled(spark, dhz):
    store = StateStore(spark, scratch_path(spark, "daily"))
    store.load(MoverRun(dhz, TH, horizon=dt.date(2024, 1, 20)).states, dt.date(2024, 1, 20))
    run_days(store, dhz, days(dt.date(2024, 1, 21), dt.date(2024, 1, 23)), TH)
    zips = scratch_path(spark, "zips")
    dhz.write.partitionBy("day").parquet(zips)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.changes(spark.read.parquet(zips), dt.date(2024, 1, 24), TH)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan, plan  # one exchange: today's rows to their users
    assert f"SelectedBucketsCount: {store.buckets} out of {store.buckets}" in plan
    scans = [x for x in plan.split("\n") if "FileScan" in x]
    exchange = plan.index("Exchange hashpartitioning")
    assert len(scans) == 2 and plan.index("version#") < exchange < plan.index(zips.rsplit("/", 1)[1])


def test_one_day_operators_on_the_stored_state_equal_the_step(two_buckets, dhz):
    """The reference's day as chained DataFrame operators (split, route, merge, confirm, evict) on yesterday's tables."""
    spark = two_buckets
    th = TH.with_(age_limit=6)
    store = StateStore(spark, scratch_path(spark, "daily"))
    start = dt.date(2024, 1, 17)
    store.load(MoverRun(dhz, th, horizon=start).states, start)
    store.advance(dhz, start + dt.timedelta(days=1), th)
    for day in days(start + dt.timedelta(days=2), start + dt.timedelta(days=3)):
        old = {t: getattr(store, t)().persist() for t in TABLES}
        today = dhz.where(F.col("day") == F.lit(day)).select("user_id", "zipcode")
        ref_feed, mover_feed = rf.feeds(today, old["reference"].select("user_id", "reference_zip"), old["pool"])
        history = rf.history_update(old["history"], ref_feed, day)
        registry = rf.registry_update(old["registry"], ref_feed, day)
        reference = old["reference"].select("user_id", "reference_zip").unionByName(rf.reference_candidates(history, registry, th)).distinct()
        merged = sk.day_state(mover_feed, old["streak"], old["pool"], day).persist()
        streak, pool = merged.where("kind = 'streak'").select(*sk.STREAK_COLS), merged.where("kind = 'pool'").select(*sk.POOL_COLS)
        confirmed = cf.week_confirmed(streak, day, th)
        home, elsewhere = cf.confirmed_home(confirmed, reference), cf.confirmed_elsewhere(confirmed, reference, day)
        returned, aged = cf.evicted_users(home, pool, day, th)
        want = {
            "history": rows(history), "reference": rows(reference), "registry": rows(registry.select("user_id", "last_seen", "first_seen", "gap_days", "tenure_days")),
            "streak": rows(cf.streak_after_eviction(streak, returned, aged)), "pool": rows(cf.pool_after_eviction(pool, elsewhere, returned, aged)),
        }
        ended = cf.end_of_day(merged, reference, day, th)  # the same evening in one exchange
        assert rows(cf.streak_at_end(ended)) == want["streak"] and rows(cf.pool_at_end(ended)) == want["pool"]
        store.advance(dhz, day, th)
        got = {t: getattr(store, t)() for t in TABLES}
        got["reference"] = got["reference"].select("user_id", "reference_zip")
        for t in TABLES:
            assert rows(got[t]) == want[t], (day, t)
        for df in (*old.values(), merged):
            df.unpersist()


def test_empty_store_and_days_without_sightings(two_buckets, dhz):
    spark = two_buckets
    store = StateStore(spark, scratch_path(spark, "daily"))
    assert store.last_day is None and store.pool().count() == store.evictions(FIRST).count() == store.history().count() == 0
    store.advance(dhz.where("false"), FIRST, TH)  # a day on which nobody was seen
    store.advance(dhz, dt.date(2024, 1, 2), TH)  # and one after it
    assert rows(store.history()) == rows(MoverRun(dhz.where("day = DATE'2024-01-02'"), TH, horizon=dt.date(2024, 1, 2)).history)


def test_command_line(two_buckets, dhz):
    spark = two_buckets
    zips, state = scratch_path(spark, "zips"), scratch_path(spark, "state")
    dhz.write.partitionBy("day").parquet(zips)
    main(["--state", state, "--home-zips", zips, "--thresholds", "fixture", *[x for d in days(FIRST, dt.date(2024, 1, 4)) for x in ("--day", d.isoformat())]])
    store = StateStore(spark, state)
    assert store.last_day == dt.date(2024, 1, 4) and rows(store.history()) == rows(MoverRun(dhz, TH, horizon=dt.date(2024, 1, 4)).history)
    assert any(n.endswith(".json") for n in sf.list_names(spark, f"{state}/manifest"))
