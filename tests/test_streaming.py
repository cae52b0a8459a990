"""Stream = batch: days arrive in three chunks through restarts of the same query."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from homeshift.config import FIXTURE_THRESHOLDS as TH
from homeshift.operators import home_zip as hz
from homeshift.plans.movers import MoverRun
from homeshift.session import scratch_path
from homeshift.sources import tables as tb
from homeshift.streaming import movers_stream as ms
from places import SF_MID, SF_SMALL


@pytest.fixture(autouse=True)
def two_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def _pool(out):
    return out.where("kind = 'pool'").select("user_id", "zipcode", F.col("week").alias("confirmed_week"), "since")


def test_mover_stream_over_restarts_equals_batch(spark):
    dhz = hz.daily_home_zip(tb.visits(spark, SF_SMALL))
    src, out, ck, closing = (scratch_path(spark, n) for n in ("src", "out", "ck", "closing"))
    dhz.limit(0).write.parquet(closing)
    cuts = [dt.date(2024, 1, 11), dt.date(2024, 1, 21), dt.date(2024, 2, 1)]
    lo = dt.date(2024, 1, 1)
    for hi in cuts:  # each chunk is a new micro-batch of a restarted query (state from the checkpoint)
        part = dhz.where((F.col("day") >= F.lit(lo)) & (F.col("day") < F.lit(hi)))
        part.write.mode("append").partitionBy("day").parquet(src)
        if hi == cuts[-1]:
            ms.close_input(spark, closing, dt.date(2024, 1, 30), 0)
        ms.mover_stream(spark, src, out, ck, TH, closing_path=closing).awaitTermination()
        lo = hi
    res = ms.latest_state(ms.read_output(spark, out))
    batch = MoverRun(dhz, TH, horizon=dt.date(2024, 1, 30))
    assert sorted(_pool(res).collect()) == sorted(batch.pool.collect())
    streak = res.where("kind = 'streak'").select("user_id", "zipcode", "streak_start")
    assert sorted(streak.collect()) == sorted(batch.streak.select("user_id", "zipcode", "streak_start").collect())
    ref = res.where("kind = 'reference'").select("user_id", F.col("zipcode").alias("reference_zip"))
    assert sorted(ref.collect()) == sorted(batch.reference.select("user_id", "reference_zip").collect())


@pytest.mark.parametrize("age", [5, 12, 148])
def test_state_crosses_micro_batches_and_equals_batch(spark, age):
    """Rows of neighbouring days mixed over restarts, lateness of 2 days: pool, streak, history and audits equal the batch run."""
    th = TH.with_(age_limit=age)
    dhz = hz.daily_home_zip_of_events(tb.table(spark, SF_MID, "events")).persist()
    batch = MoverRun(dhz, th, horizon=dt.date(2024, 1, 30))
    out = ms.run_mover_stream(dhz, th).persist()
    assert ms.late_rows(out).count() == 0
    per_user = out.groupBy("user_id").agg(F.countDistinct("batch").alias("n")).agg(F.min("n"), F.max("n")).first()
    assert per_user[1] >= 5  # users whose state was stored and read again over at least five micro-batches
    res = ms.latest_state(out)
    assert sorted(_pool(res).collect()) == sorted(batch.pool.collect())
    streak = res.where("kind = 'streak'").select("user_id", "zipcode", "streak_start", "weekend_days", "weekday_days", F.col("week").alias("week_no"))
    assert sorted(streak.collect()) == sorted(batch.streak.collect())
    ref = res.where("kind = 'reference'").select("user_id", "zipcode", "day")
    assert sorted(ref.collect()) == sorted(batch.reference.collect())
    audits = out.where("kind in ('returned', 'aged')").groupBy("user_id", "day", F.col("kind").alias("reason")).agg(F.max("presence_days"))
    assert sorted(audits.collect()) == sorted(batch.evictions.collect())
    aged = out.where("kind = 'aged'").select("user_id", "zipcode", "week", "since", "date_min", "date_max", "day", "presence_days")
    assert sorted(aged.collect()) == sorted(batch.aged.collect())
    out.unpersist()
    dhz.unpersist()


def test_late_rows_are_kept_apart_and_corrected(spark):
    """One sighting in twenty comes ten days late: the stream alone is wrong, the correction job makes it equal to the batch run."""
    dhz = hz.daily_home_zip_of_events(tb.table(spark, SF_MID, "events")).persist()
    run = ms.BoundedRun(dhz, TH, delay=F.expr("CASE WHEN pmod(xxhash64(day, user_id), 20) = 0 THEN 10 ELSE 0 END"))
    out = run.run().persist()
    late = ms.late_rows(out).select("user_id", "zipcode", "day")
    want = dhz.where("pmod(xxhash64(day, user_id), 20) = 0").select("user_id", "zipcode", "day")
    got = set(map(tuple, late.collect()))
    assert got and got <= set(map(tuple, want.collect()))  # only delayed rows are late
    horizon = dt.date(2024, 1, 30)
    batch = MoverRun(dhz, TH, horizon=horizon)
    assert sorted(ms.stream_pool(out).collect()) != sorted(batch.pool.collect())
    corrected = ms.correct_late(out, run.day_history(), TH, F.lit(horizon)).persist()
    assert {r[0] for r in corrected.select("user_id").collect()} == {u for u, *_ in got}
    assert sorted(ms.corrected_pool(out, corrected).collect()) == sorted(batch.pool.collect())
    for df in (out, corrected, dhz):
        df.unpersist()


def test_small_lateness_applies_days_in_order(spark):
    """Rows of neighbouring days swapped between micro-batches, within the lateness."""
    rows = [(1, z, dt.date(2024, 1, d)) for d, z in [(2, "b"), (1, "a"), (4, "d"), (3, "c"), (6, "f"), (5, "e")]]
    src, out, ck, closing = (scratch_path(spark, n) for n in ("src", "out", "ck", "closing"))
    spark.createDataFrame([], "user_id long, zipcode string, day date").write.parquet(closing)
    for row in rows:
        spark.createDataFrame([row], "user_id long, zipcode string, day date").write.mode("append").parquet(src)
        ms.mover_stream(spark, src, out, ck, TH.with_(min_days=1, min_share=0.0), lateness_days=2, closing_path=closing).awaitTermination()
    ms.close_input(spark, closing, dt.date(2024, 1, 6), 2)
    ms.mover_stream(spark, src, out, ck, TH.with_(min_days=1, min_share=0.0), lateness_days=2, closing_path=closing).awaitTermination()
    res = ms.latest_state(ms.read_output(spark, out))
    assert [tuple(r) for r in res.where("kind = 'reference'").select("zipcode", "day").collect()] == [("a", dt.date(2024, 1, 1))]
    assert sorted(r[0] for r in res.where("kind = 'pool'").select("zipcode").collect()) == ["b", "c", "d", "e", "f"]


class _Store:
    """State variables, timers and watermark of one group; every access counts as a call."""

    def __init__(self):
        self.calls, self.timers, self.watermark = 0, set(), 0

    def getValueState(self, name, schema):
        return _Variable(self, None)

    def getListState(self, name, schema):
        return _Variable(self, [])

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)

    def getCurrentWatermarkInMs(self):
        return self.watermark


class _Variable:
    def __init__(self, store, value):
        self.store, self.value, self.none = store, value, value

    def get(self):
        self.store.calls += 1
        return self.value

    def update(self, value):
        self.store.calls += 1
        self.value = value

    def appendValue(self, value):
        self.store.calls += 1
        self.value = self.value + [value]

    def clear(self):
        self.store.calls += 1
        self.value = self.none


def _feed_group(days, th):
    """(rows handed out, store calls) of one group fed a list of (user, zip, day) a micro-batch, its last day closed at the end."""
    store, out = _Store(), []
    p = ms.MoverProcessor(th)
    p.init(store)
    for batch, watermark_day in days:
        store.watermark = watermark_day * ms.DAY_MS
        frame = pd.DataFrame({"user": [str(u) for u, _, _ in batch], "zipcode": [z for _, z, _ in batch], "day": [d for _, _, d in batch]})
        out += p.handleInputRows((0,), iter([frame] if batch else []), store)
        for at in sorted(t for t in store.timers if t < store.watermark):
            out += p.handleExpiredTimer((0,), store, None)
            store.timers.remove(at)
    return [tuple(r) for frame in out for r in frame.itertuples(index=False)], store.calls


def test_store_calls_of_a_group_do_not_grow_with_its_users():
    """Three hundred users cost as many store calls as one, and each gets the rows it gets alone."""
    th = TH.with_(min_days=2, age_limit=4)

    def feed(users):
        sight = lambda d: [(u, f"{75001 + (u * d if d > 102 else u)}", d) for u in users]
        return _feed_group([(sight(101) + sight(100), 0), (sight(103) + sight(104), 102), (sight(106), 104), ([], 107), ([], 120)], th)

    rows, calls = feed(range(2, 302))
    alone, calls_alone = feed([7])
    assert calls == calls_alone
    assert [r for r in rows if r[0] == 7] == alone
    assert {"pool", "streak", "reference", "aged"} <= {r[1] for r in alone}
    assert {r[0] for r in rows} == set(range(2, 302))


def test_late_rows_of_a_group_leave_its_other_users_alone():
    """A late row is handed out once for its own user; ids that a double can't hold, and null, stay apart in a group."""
    th = TH.with_(min_days=1, min_share=0.0)
    big = 2 ** 53
    days = [([(big, "75001", 100), (big + 1, "75002", 100)], 0), ([(big, "75003", 100), (big + 1, "75004", 103)], 102), ([], 110)]
    rows, _ = _feed_group(days, th)
    late = [r for r in rows if r[1] == "late"]
    assert [(r[0], r[ms.STORED_OUTPUT.fieldNames().index("zipcode")]) for r in late] == [(big, "75003")]
    assert [r for r in rows if r[0] == big + 1] == _feed_group([([t for t in b if t[0] == big + 1], w) for b, w in days], th)[0]
    assert not any(r[1] == "pool" for r in rows if r[0] == big)

    p = ms.MoverProcessor(th)
    p.init(store := _Store())
    assert not list(p.handleInputRows((0,), iter([pd.DataFrame({"user": [None, "5", str(ms.MARKER_USER)], "zipcode": ["75001"] * 3, "day": [100] * 3})]), store))
    store.watermark = 102 * ms.DAY_MS
    (out,) = p.handleExpiredTimer((0,), store, None)
    assert out["user_id"].tolist() == [None, 5]


def test_user_groups_are_those_of_the_first_start(spark):
    """State is kept by group, so a restart with another number of groups goes on with the first one."""
    rows = lambda *days: spark.createDataFrame([(1, f"7500{d}", dt.date(2024, 1, d)) for d in days], "user_id long, zipcode string, day date")
    src, out, ck = (scratch_path(spark, n) for n in ("src", "out", "ck"))
    th = TH.with_(min_days=1, min_share=0.0)
    for days, groups in (((1,), 7), ((2, 9), 1000)):
        rows(*days).write.mode("append").parquet(src)
        ms.mover_stream(spark, src, out, ck, th, groups=groups).awaitTermination()
    res = ms.latest_state(ms.read_output(spark, out))
    assert [tuple(r) for r in res.where("kind = 'reference'").select("zipcode", "day").collect()] == [("75001", dt.date(2024, 1, 1))]
    assert [r[0] for r in res.where("kind = 'pool'").select("zipcode").collect()] == ["75002"]


@pytest.mark.parametrize("delay", [None, "CASE WHEN user_id % 4 = 1 AND day = date'2024-01-03' THEN 10 ELSE 0 END"])
def test_state_stores_are_few_for_their_users(spark, delay):
    """A store costs as much a micro-batch as thousands of users, so two thousand users share one; the rows stay those of the batch run."""
    zipcode = F.when(F.col("d") < 3, "75001").otherwise("75002")
    dhz = spark.range(2000).crossJoin(spark.range(6).toDF("d")).select(F.col("id").alias("user_id"), zipcode.alias("zipcode"), F.expr("date_add(date'2024-01-01', cast(d as int))").alias("day"))
    th = TH.with_(min_days=2)
    run = ms.BoundedRun(dhz, th, delay=None if delay is None else F.expr(delay))
    out = run.run()
    horizon = dt.date(2024, 1, 6)
    pool = ms.stream_pool(out) if delay is None else ms.corrected_pool(out, ms.correct_late(out, run.day_history(), th, F.lit(horizon)))
    assert ms.late_rows(out).count() == (0 if delay is None else 500)
    assert len(spark.read.format("binaryFile").option("pathGlobFilter", "1.zip").load(f"{run.checkpoint}/state/0/*").select("path").collect()) == 1
    assert run.groups > 5
    want = MoverRun(dhz, th, horizon=horizon).pool
    assert pool.count() == 2000 and sorted(pool.collect()) == sorted(want.collect())


def test_daily_home_zip_stream_emits_every_day(spark):
    got = ms.run_daily_home_zip_stream(spark, f"{SF_SMALL}/events.parquet")
    want = hz.daily_home_zip(tb.visits(spark, SF_SMALL))
    assert sorted(got.collect()) == sorted(want.collect())


def test_results_do_not_depend_on_session_time_zone(spark):
    from oracle_compare import compare

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        res = compare(spark, SF_SMALL, ["stream_daily_home_zip", "daily_home_zip", "moves"], verbose=False)
        assert all(all(v) for v in res.values()), res
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
