"""One user's days as a state machine of Spark expressions: no Python at run time.

An evicted user is routed again from scratch, so eviction feeds back into everything before it and the chain
has no window form.  Users never interact, though, and a user has at most one sighting a day.  So the state of a user is
one typed struct (``STATE``), a sighting is one step on it, and

* a whole run is ``aggregate(sorted sightings, empty state, step)``, one group a user (``replay``);
* a day of the daily job is ``step`` on the stored state of the users seen that day (``plans.daily``);
* days without a sighting need no step: the pool age is checked before the next one and on the last day (``aged_on``).

``step`` is the rule set of ``fold.UserState.observe``, which the stream runs; the tests hold them against each other.

Steps of one sighting (day d, zip z), in order: pool age over the limit on an earlier day -> evicted that day; route (no
reference yet, or at the reference zip and not in the pool: feeds the history; else mover); a fed
history may fix the reference; a mover's streak goes on or starts anew, with a pool row of week 0; an exact 7-day
anniversary that passes the weekly test is a return home or a pool row of that week; pool age over the limit today -> evicted.

The group of a user is its sightings (one a day), so its size is bounded by the length of the run, never by the number of raw rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeshift.config import Thresholds
from homeshift.functions.dates import inclusive_day_diff, is_weekend
from homeshift.operators.partitioning import by_user_partitions
from homeshift.operators.reference import qualifies
from homeshift.operators.streak import week_passes

STREAK = "struct<zipcode:string,start:date,weekend_days:bigint,weekday_days:bigint,week:int>"
POOL_ROW = "struct<zipcode:string,week:int,since:date>"
FED = "struct<zipcode:string,weekend_days:bigint,weekday_days:bigint>"
AUDIT = "struct<kind:string,day:date,zipcode:string,week:int,since:date,date_min:date,date_max:date,presence_days:int>"

#: State of a user: reference, current streak, pool rows, first pool day, fed history, first / last / previous fed day, audits.
STATE = {
    "reference_zip": "string", "ref_day": "date", "streak": STREAK, "pool": f"array<{POOL_ROW}>", "first": "date", "fed": f"array<{FED}>",
    "fed_first": "date", "fed_last": "date", "fed_before": "date", "audits": f"array<{AUDIT}>",
}
STATE_DDL = "struct<" + ",".join(f"{k}:{v}" for k, v in STATE.items()) + ">"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _struct(ddl: str, /, **cols) -> Column:
    return F.struct(*[F.lit(c).alias(k) if not isinstance(c, Column) else c.alias(k) for k, c in cols.items()]).cast(ddl)


def _none(ddl: str) -> Column:
    return F.lit(None).cast(ddl)


def empty_state() -> Column:
    return _struct(STATE_DDL, **{k: F.array().cast(t) if t.startswith("array") else _none(t) for k, t in STATE.items()})


def _with(s: Column, **changed: Column) -> Column:
    return _struct(STATE_DDL, **{k: changed.get(k, s[k]) for k in STATE})


def _cleared(s: Column, audits: Column) -> Column:
    """Out of the pool: no streak, no pool rows; reference and history stay."""
    return _with(s, streak=_none(STREAK), pool=F.array().cast(STATE["pool"]), first=_none("date"), audits=F.concat(s["audits"], audits))


def _last_since(s: Column) -> Column:
    return F.array_max(F.transform(s["pool"], lambda p: p["since"]))


def aged_audits(s: Column, day: Column) -> Column:
    """One audit row a pool row of a user evicted for its age on ``day``."""
    return let(_last_since(s), lambda last: F.transform(s["pool"], lambda p: _struct(
        AUDIT, kind="aged", day=day, zipcode=p["zipcode"], week=p["week"], since=p["since"], date_min=s["first"], date_max=last,
        presence_days=inclusive_day_diff(day, s["first"]))))


def aged_on(s: Column, day: Column, th: Thresholds) -> Column:
    """Pool age check at the end of ``day``: the user was evicted on the last day within the limit."""
    over = s["first"].isNotNull() & (inclusive_day_diff(day, s["first"]) > th.age_limit)
    return F.when(over, _cleared(s, aged_audits(s, F.date_add(s["first"], th.age_limit)))).otherwise(s)


def _has(rows: Column, zipcode: Column, week: Column) -> Column:
    return F.exists(rows, lambda p: (p["zipcode"] == zipcode) & (p["week"] == week))


def _pool_with(rows: Column, zipcode: Column, week: Column, day: Column) -> Column:
    """A pool row of (zip, week) once; days only grow, so the first one is the earliest."""
    return F.when(_has(rows, zipcode, week), rows).otherwise(F.concat(rows, F.array(_struct(POOL_ROW, zipcode=zipcode, week=week, since=day))))


def _feed(s: Column, day: Column, zipcode: Column, th: Thresholds) -> Column:
    """The sighting counts in the history, and may fix the reference."""
    we = is_weekend(day).cast("bigint")
    sem = F.lit(1) - we
    known = F.exists(s["fed"], lambda f: f["zipcode"] == zipcode)
    counted = F.transform(s["fed"], lambda f: F.when(f["zipcode"] == zipcode, _struct(
        FED, zipcode=f["zipcode"], weekend_days=f["weekend_days"] + we, weekday_days=f["weekday_days"] + sem)).otherwise(f))
    added = F.concat(s["fed"], F.array(_struct(FED, zipcode=zipcode, weekend_days=we, weekday_days=sem)))

    def fixed(fed: Column) -> Column:
        days = F.get(F.transform(F.filter(fed, lambda f: f["zipcode"] == zipcode), lambda f: f["weekend_days"] + f["weekday_days"]), F.lit(0))
        first = F.coalesce(s["fed_first"], day)
        new = s["ref_day"].isNull() & qualifies(days, inclusive_day_diff(day, first), th)
        return _with(
            s, fed=fed, fed_first=first, fed_last=day, fed_before=s["fed_last"],
            reference_zip=F.when(new, zipcode).otherwise(s["reference_zip"]), ref_day=F.when(new, day).otherwise(s["ref_day"]),
        )

    return let(F.when(known, counted).otherwise(added), fixed)


def _move(s: Column, day: Column, zipcode: Column, th: Thresholds) -> Column:
    """The sighting of a mover: streak, pool, confirmation, eviction."""
    we = is_weekend(day).cast("bigint")
    old = s["streak"]
    same = old.isNotNull() & (old["zipcode"] == zipcode)
    age = F.when(same, inclusive_day_diff(day, old["start"])).otherwise(F.lit(1))
    streak = F.when(same, _struct(
        STREAK, zipcode=zipcode, start=old["start"], weekend_days=old["weekend_days"] + we, weekday_days=old["weekday_days"] + F.lit(1) - we,
        week=F.floor(age / 7).cast("int"),
    )).otherwise(_struct(STREAK, zipcode=zipcode, start=day, weekend_days=we, weekday_days=F.lit(1) - we, week=F.lit(0)))

    def moved(m: Column) -> Column:
        t = m["streak"]
        wk_we, wk_sem = t["weekend_days"], t["weekday_days"]
        confirmed = (m["age"] >= 7) & (m["age"] % 7 == 0) & week_passes(wk_we, wk_sem, wk_we, wk_sem, th)
        presence = inclusive_day_diff(day, m["first"])
        at_home = zipcode == s["reference_zip"]
        now = _with(s, streak=t, pool=m["pool"], first=m["first"])
        returned = confirmed & at_home & (presence <= th.return_limit)
        aged = presence > th.age_limit

        def end(n: Column) -> Column:
            home = F.array(_struct(AUDIT, kind="returned", day=day, zipcode=zipcode, week=t["week"], since=_none("date"), date_min=n["first"], date_max=_last_since(n), presence_days=presence))
            none = F.array().cast(STATE["audits"])
            return (
                F.when(aged, _cleared(n, F.concat(F.when(returned, home).otherwise(none), aged_audits(n, day))))
                .when(returned, _cleared(n, home))
                .when(confirmed & ~at_home, _with(n, pool=_pool_with(n["pool"], zipcode, t["week"], day)))
                .otherwise(n)
            )

        return let(now, end)

    start = F.when(same, s["pool"]).otherwise(_pool_with(s["pool"], zipcode, F.lit(0), day))
    return let(F.struct(streak.alias("streak"), start.alias("pool"), F.coalesce(s["first"], day).alias("first"), age.alias("age")), moved)


def step(state: Column, day: Column, zipcode: Column, th: Thresholds) -> Column:
    """State after the sighting of one day (days in increasing order)."""

    def routed(s: Column) -> Column:
        fed = s["ref_day"].isNull() | (s["first"].isNull() & (zipcode == s["reference_zip"]))
        return F.when(fed, _feed(s, day, zipcode, th)).otherwise(_move(s, day, zipcode, th))

    return let(aged_on(state, F.date_sub(day, 1), th), routed)


# ------------------------------------------------------------------- whole run

def replay(dhz: DataFrame, horizon: Column, th: Thresholds) -> DataFrame:
    """(user_id, horizon, n_days, state fields) of every user at the end of the day ``horizon``: one group a user."""
    days = F.sort_array(F.collect_list(F.struct("day", "zipcode")))
    users = by_user_partitions(dhz).groupBy("user_id").agg(days.alias("days"))
    end = F.aggregate("days", empty_state(), lambda s, d: step(s, d["day"], d["zipcode"], th))
    out = users.select("user_id", F.size("days").alias("n_days"), end.alias("s")).withColumn("horizon", horizon)
    return out.withColumn("s", aged_on(F.col("s"), F.col("horizon"), th)).select("user_id", "horizon", "n_days", "s.*")


# ------------------------------------------------------ tables of stored states

def reference(states: DataFrame) -> DataFrame:
    return states.where("ref_day is not null").select("user_id", "reference_zip", "ref_day")


def history(states: DataFrame) -> DataFrame:
    return states.select("user_id", F.inline("fed"))


def registry(states: DataFrame, day: Column) -> DataFrame:
    """First and last fed day, gap and tenure on ``day``: a user fed today keeps the gap to the day before that one."""
    before = F.when(F.col("fed_last") < day, F.col("fed_last")).otherwise(F.col("fed_before"))
    return states.where("fed_first is not null").select(
        "user_id", F.col("fed_last").alias("last_seen"), F.col("fed_first").alias("first_seen"),
        F.coalesce(inclusive_day_diff(day, before), F.lit(1)).alias("gap_days"), inclusive_day_diff(day, "fed_first").alias("tenure_days"),
    )


def pool(states: DataFrame, *keep: str) -> DataFrame:
    return states.select("user_id", *keep, F.inline("pool")).withColumnRenamed("week", "confirmed_week")


def streak(states: DataFrame) -> DataFrame:
    return states.where("streak is not null").select(
        "user_id", "streak.zipcode", F.col("streak.start").alias("streak_start"), "streak.weekend_days", "streak.weekday_days", F.col("streak.week").alias("week_no")
    )


def audits(states: DataFrame) -> DataFrame:
    return states.select("user_id", F.inline("audits"))
