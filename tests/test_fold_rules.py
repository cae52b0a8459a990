"""Edge cases of the per-user step (pure Python, no Spark)."""

import datetime as dt

from homeshift.config import FIXTURE_THRESHOLDS as TH
from homeshift.operators.fold import EPOCH, FOLD_COLUMNS, UserState

REF = "75001"
AWAY = "13001"
# Monday 2024-01-01 .. : weekdays and weekends follow the real calendar
D0 = dt.date(2024, 1, 1)


def n(d: dt.date) -> int:
    return (d - EPOCH).days


def run(seq, th=TH, ref_day=None, horizon=None):
    """seq: list of (date, zip); the user has reference REF fixed on ref_day (default: day before seq)."""
    ref_day = ref_day or seq[0][0] - dt.timedelta(days=1)
    u = UserState(1, REF, n(ref_day), th)
    for d, z in seq:
        u.observe(n(d), z, d.weekday() >= 5)
    rows = u.close(n(horizon or seq[-1][0]))
    return rows


def kinds(rows, kind):
    return [dict(zip(FOLD_COLUMNS, r)) for r in rows if r[1] == kind]


def days(start, k, zipcode):
    return [(start + dt.timedelta(days=i), zipcode) for i in range(k)]


def test_seen_every_day_confirms_week_one():
    rows = run(days(D0, 7, AWAY))
    pool = {(r["zipcode"], r["week"]) for r in kinds(rows, "pool")}
    assert pool == {(AWAY, 0), (AWAY, 1)}


def test_anniversary_missed_is_not_confirmed():
    seq = days(D0, 6, AWAY) + [(D0 + dt.timedelta(days=7), AWAY)]  # days 1-6 and 8
    pool = {(r["zipcode"], r["week"]) for r in kinds(run(seq), "pool")}
    assert pool == {(AWAY, 0)}
    streak = kinds(run(seq), "streak")[0]
    assert streak["week"] == 1  # week number moved on day 8 (8 // 7)


def test_home_sighting_while_in_pool_opens_streak_at_reference():
    seq = days(D0, 3, AWAY) + [(D0 + dt.timedelta(days=3), REF)]
    pool = {(r["zipcode"], r["week"]) for r in kinds(run(seq), "pool")}
    assert pool == {(AWAY, 0), (REF, 0)}


def _return_at(presence: int):
    """User enters the pool, comes home so that the 7-day confirmation falls at ``presence``."""
    start_home = presence - 6  # home streak days presence-6 .. presence (7 days)
    seq = [(D0, AWAY)] + days(D0 + dt.timedelta(days=start_home - 1), 7, REF)
    return run(seq)


def test_return_at_presence_28_is_evicted():
    rows = _return_at(28)
    assert len(kinds(rows, "returned")) == 1
    assert kinds(rows, "pool") == [] and kinds(rows, "streak") == []


def test_return_at_presence_29_is_kept():
    rows = _return_at(29)
    assert kinds(rows, "returned") == []
    assert {r["zipcode"] for r in kinds(rows, "pool")} == {AWAY, REF}


def test_pool_age_148_kept_149_evicted():
    seq = [(D0, AWAY)]
    kept = run(seq, horizon=D0 + dt.timedelta(days=147))  # presence 148
    gone = run(seq, horizon=D0 + dt.timedelta(days=148))  # presence 149
    assert kinds(kept, "aged") == [] and len(kinds(kept, "pool")) == 1
    assert len(kinds(gone, "aged")) == 1 and kinds(gone, "pool") == []
    assert kinds(gone, "aged")[0]["day"] == D0 + dt.timedelta(days=148)


def test_reentry_after_eviction_starts_new_streak():
    th = TH.with_(age_limit=5)
    seq = [(D0, AWAY), (D0 + dt.timedelta(days=10), "13002")]
    rows = run(seq, th=th)
    assert len(kinds(rows, "aged")) == 1
    pool = [(r["zipcode"], r["week"], r["since"]) for r in kinds(rows, "pool")]
    assert pool == [("13002", 0, D0 + dt.timedelta(days=10))]
    assert kinds(rows, "streak")[0]["streak_start"] == D0 + dt.timedelta(days=10)


def test_home_after_eviction_feeds_history():
    th = TH.with_(age_limit=5)
    seq = [(D0, AWAY), (D0 + dt.timedelta(days=10), REF)]
    rows = run(seq, th=th)
    hist = {r["zipcode"]: (r["weekend_days"], r["weekday_days"]) for r in kinds(rows, "history")}
    assert REF in hist and kinds(rows, "pool") == []


def test_before_reference_everything_feeds_history():
    u = UserState(7, None, None, TH)
    for i in range(3):
        d = D0 + dt.timedelta(days=i)
        u.observe(n(d), AWAY, d.weekday() >= 5)
    rows = u.close(n(D0 + dt.timedelta(days=5)))
    reg = kinds(rows, "registry")[0]
    assert reg["tenure_days"] == 6 and reg["gap_days"] == 4  # tenure 6 days, gap from the last feed day (day 3) to day 6
    assert kinds(rows, "reference") == []
