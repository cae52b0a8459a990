"""The state machine in Spark expressions equals the step in plain Python (which the stream runs), user by user."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from homeshift.config import FIXTURE_THRESHOLDS as TH
from homeshift.operators import home_zip as hz
from homeshift.operators import user_state as us
from homeshift.operators.fold import EPOCH, FOLD_COLUMNS, UserState
from homeshift.plans.movers import MoverRun
from homeshift.sources import tables as tb
from places import SF_MID

D0 = dt.date(2024, 1, 1)
COLS = {
    "reference": ["user_id", "zipcode", "day"], "history": ["user_id", "zipcode", "weekend_days", "weekday_days"],
    "registry": ["user_id", "last_seen", "first_seen", "gap_days", "tenure_days"], "pool": ["user_id", "zipcode", "week", "since"],
    "streak": ["user_id", "zipcode", "streak_start", "weekend_days", "weekday_days", "week"],
    "returned": ["user_id", "zipcode", "week", "date_min", "date_max", "day", "presence_days"],
    "aged": ["user_id", "zipcode", "week", "since", "date_min", "date_max", "day", "presence_days"],
}


def plain(rows, horizon, th):
    """Final rows by kind, by the Python step."""
    users = {}
    for u, z, d in sorted(rows, key=lambda r: (r[0], r[2])):
        users.setdefault(u, UserState(u, None, None, th, learn=True)).observe((d - EPOCH).days, z, d.weekday() >= 5)
    out = {k: [] for k in COLS}
    for u in users.values():
        for r in u.close((horizon - EPOCH).days):
            row = dict(zip(FOLD_COLUMNS, r))
            out[row["kind"]].append(tuple(row[c] for c in COLS[row["kind"]]))
    return {k: sorted(v) for k, v in out.items()}


def native(run):
    audits = us.audits(run.states)
    tables = {
        "reference": run.reference, "history": run.history, "registry": run.registry, "pool": run.pool, "streak": run.streak,
        "returned": audits.where("kind = 'returned'").select(*COLS["returned"]), "aged": audits.where("kind = 'aged'").select(*COLS["aged"]),
    }
    return {k: sorted(map(tuple, t.collect())) for k, t in tables.items()}


def random_days(seed, users=150, days=90):
    rng, rows = random.Random(seed), []
    for u in range(users):
        home, zips, at = rng.random(), ["75001", "13001", "69001"], 0
        for i in range(days):
            if rng.random() < 0.06:
                at = rng.randrange(3)
            if rng.random() < 0.55 + 0.45 * home:
                z = zips[0] if i < 12 and rng.random() < 0.9 else zips[at] if rng.random() < 0.93 else rng.choice(zips)
                rows.append((u, z, D0 + dt.timedelta(days=i)))
    return rows


@pytest.mark.parametrize("seed, limits", [(1, (28, 148)), (2, (28, 12)), (3, (10, 9)), (4, (60, 30)), (5, (28, 28))])
def test_random_users(spark, seed, limits):
    th = TH.with_(return_limit=limits[0], age_limit=limits[1])
    rows = random_days(seed)
    horizon = D0 + dt.timedelta(days=95)
    want = plain(rows, horizon, th)
    run = MoverRun(spark.createDataFrame(rows, "user_id long, zipcode string, day date"), th, horizon=horizon)
    got = native(run)
    for kind in COLS:
        assert got[kind] == want[kind], kind
    assert want["pool"] and want["returned"] and (limits[1] > 95 or want["aged"])


@pytest.mark.parametrize("limits", [(28, 148), (28, 12), (28, 5)])
def test_given_users(spark, limits):
    th = TH.with_(return_limit=limits[0], age_limit=limits[1])
    dhz = hz.daily_home_zip_of_events(tb.table(spark, SF_MID, "events"))
    run = MoverRun(dhz, th, horizon=tb.last_day(spark, SF_MID))
    assert native(run) == plain([tuple(r) for r in dhz.collect()], dt.date(2024, 1, 30), th)


def test_empty_input_and_unknown_days(spark):
    none = spark.createDataFrame([], "user_id long, zipcode string, day date")
    run = MoverRun(none, TH, horizon=D0)
    assert all(not v for v in native(run).values()) and run.moves.count() == 0
    assert run.counts().first()["daily_home_zip_rows"] == 0


def test_a_sighting_is_one_step(spark):
    """A stored state taken one step further equals the replay of all days."""
    rows = random_days(8, users=40, days=40)
    df = spark.createDataFrame(rows, "user_id long, zipcode string, day date")
    cut = D0 + dt.timedelta(days=39)
    th = TH.with_(age_limit=20)
    before = us.replay(df.where(F.col("day") < F.lit(cut)), F.lit(cut - dt.timedelta(days=1)), th)
    today = df.where(F.col("day") == F.lit(cut)).select("user_id", "zipcode")
    s = F.struct(*us.STATE).cast(us.STATE_DDL)
    stepped = before.join(today, "user_id").select("user_id", us.aged_on(us.step(s, F.lit(cut), F.col("zipcode"), th), F.lit(cut), th).alias("s")).select("user_id", "s.*")
    whole = us.replay(df, F.lit(cut), th).join(today.select("user_id"), "user_id", "left_semi").join(before.select("user_id"), "user_id", "left_semi")
    cols = ["user_id", *us.STATE]
    assert sorted(map(str, stepped.select(*cols).collect())) == sorted(map(str, whole.select(*cols).collect()))
