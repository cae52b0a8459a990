"""Streaks at a new zipcode and the mover pool.

One-day operators (the reference's four branches for today's mover feed
against the streak table, then the merges), and the closed form without
eviction: once a user with a reference is seen away from it, every later
sighting is a mover sighting; a streak is a run of equal zipcodes over those
sightings (gaps and islands), and the pool holds the first day of each run
plus the confirmed anniversaries away from the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homeshift.config import Thresholds
from homeshift.functions.dates import elapsed_weeks, inclusive_day_diff, weekday_flag, weekend_flag
from homeshift.functions.zips import safe_share
from homeshift.operators.partitioning import by_user_partitions
from homeshift.operators.reference import ROUTE_HOME, ROUTE_MOVER, ROUTE_REFERENCE, by_user

STREAK_COLS = ["user_id", "zipcode", "streak_start", "weekend_days", "weekday_days", "week_no"]
POOL_COLS = ["user_id", "zipcode", "confirmed_week", "since"]


def _counters(day: Column, base_we=None, base_sem=None):
    we = weekend_flag(day).cast("bigint")
    sem = weekday_flag(day).cast("bigint")
    if base_we is not None:
        we, sem = base_we + we, base_sem + sem
    return we.alias("weekend_days"), sem.alias("weekday_days")


def week_passes(we: Column, sem: Column, tot_we: Column, tot_sem: Column, th: Thresholds) -> Column:
    """Weekly confirmation test on day counts and their shares of the week totals."""
    return (
        (tot_we >= th.week_min_weekend)
        & (tot_sem >= th.week_min_weekday)
        & (safe_share(we, tot_we) >= th.week_share_weekend)
        & (safe_share(sem, tot_sem) >= th.week_share_weekday)
    )


# ---------------------------------------------------------------- one day

def streak_new(feed: DataFrame, streak: DataFrame, day) -> DataFrame:
    """A: mover-feed users without a streak start one today."""
    d = F.lit(day)
    return feed.join(streak.select("user_id"), "user_id", "left_anti").select(
        "user_id", "zipcode", d.alias("streak_start"), *_counters(d), F.lit(0).alias("week_no")
    )


def streak_continued(feed: DataFrame, streak: DataFrame, day) -> DataFrame:
    """B: same zip as the streak: count the day, move the week number."""
    d = F.lit(day)
    s = streak.alias("s")
    return feed.join(s, ["user_id", "zipcode"], "inner").select(
        "user_id", "zipcode", "streak_start",
        *_counters(d, F.col("s.weekend_days"), F.col("s.weekday_days")),
        elapsed_weeks(d, "streak_start").alias("week_no"),
    )


def streak_changed(feed: DataFrame, streak: DataFrame, day) -> DataFrame:
    """C: another zip than the streak: a new streak at today's zip."""
    d = F.lit(day)
    f, s = feed.alias("f"), streak.alias("s")
    return f.join(s, F.col("f.user_id") == F.col("s.user_id"), "inner").where(
        F.col("f.zipcode") != F.col("s.zipcode")
    ).select(
        F.col("f.user_id").alias("user_id"), F.col("f.zipcode").alias("zipcode"),
        d.alias("streak_start"), *_counters(d), F.lit(0).alias("week_no"),
    )


def streak_unseen(feed: DataFrame, streak: DataFrame) -> DataFrame:
    """D: streaks of users not in today's mover feed stay as they are."""
    return streak.join(feed.select("user_id"), "user_id", "left_anti").select(*STREAK_COLS)


def streak_other_zip(feed: DataFrame, streak: DataFrame) -> DataFrame:
    """Streak rows of seen users at another zip than today's (the rows dropped by C)."""
    f, s = feed.alias("f"), streak.alias("s")
    return s.join(f, F.col("f.user_id") == F.col("s.user_id"), "inner").where(
        F.col("f.zipcode") != F.col("s.zipcode")
    ).select(*[F.col(f"s.{c}").alias(c) for c in STREAK_COLS], F.col("f.zipcode").alias("new_zip"))


def day_pass(feed: DataFrame, streak: DataFrame, day, pool: DataFrame | None = None) -> DataFrame:
    """Branches A, B, C and D (and the pool rows they start) in one pass, without a join.

    Feed, streak and pool rows of a user meet by one exchange on ``user_id``; windows
    over the user tell each streak row today's zip and the feed row whether a streak
    at its zip exists.  Rows are tagged ``kind`` (streak or pool).
    """
    d, none = F.lit(day), F.lit(None)
    cols = ["user_id", "zipcode", "streak_start", "weekend_days", "weekday_days", "week_no"]
    rows = feed.select("user_id", "zipcode", none.cast("date").alias("streak_start"), *_counters(d), F.lit(0).alias("week_no")).withColumn("src", F.lit("feed"))
    rows = rows.unionByName(streak.select(*cols).withColumn("src", F.lit("streak")))
    rows = rows.withColumn("confirmed_week", none.cast("int")).withColumn("since", none.cast("date"))
    if pool is not None:
        rows = rows.unionByName(pool.select(*POOL_COLS).withColumn("src", F.lit("pool")), allowMissingColumns=True)
    feed_row, streak_row = F.col("src") == "feed", F.col("src") == "streak"
    rows = by_user_partitions(rows)
    rows = rows.withColumn("today", F.max(F.when(feed_row, F.col("zipcode"))).over(by_user()))
    goes_on = F.max(F.when(streak_row, F.col("zipcode") == F.col("today"))).over(by_user())
    rows = rows.withColumn("goes_on", F.coalesce(goes_on, F.lit(False)))
    seen = streak_row & F.col("today").isNotNull()
    add_we, add_sem = _counters(d)
    old = rows.where(streak_row & (F.col("today").isNull() | (F.col("zipcode") == F.col("today")))).select(
        F.lit("streak").alias("kind"), "user_id", "zipcode", "streak_start",
        F.when(seen, F.col("weekend_days") + add_we).otherwise(F.col("weekend_days")).alias("weekend_days"),
        F.when(seen, F.col("weekday_days") + add_sem).otherwise(F.col("weekday_days")).alias("weekday_days"),
        F.when(seen, elapsed_weeks(d, "streak_start")).otherwise(F.col("week_no")).alias("week_no"),
        "confirmed_week", "since",
    )
    # a started streak is a streak row and a week-0 pool row
    started = rows.where(feed_row & ~F.col("goes_on")).withColumn("kind", F.explode(F.array(F.lit("streak"), F.lit("pool")))).select(
        "kind", "user_id", "zipcode", d.alias("streak_start"), "weekend_days", "weekday_days", "week_no",
        F.lit(0).alias("confirmed_week"), d.alias("since"),
    )
    out = old.unionByName(started)
    if pool is not None:
        out = out.unionByName(rows.where(F.col("src") == "pool").select(F.lit("pool").alias("kind"), *cols, "confirmed_week", "since"))
    return out


def streak_rows(passed: DataFrame) -> DataFrame:
    return passed.where("kind = 'streak'").groupBy("user_id", "zipcode").agg(
        F.min("streak_start").alias("streak_start"),
        F.sum("weekend_days").cast("bigint").alias("weekend_days"),
        F.sum("weekday_days").cast("bigint").alias("weekday_days"),
        F.max("week_no").alias("week_no"),
    )


def pool_rows(passed: DataFrame) -> DataFrame:
    return passed.where("kind = 'pool'").groupBy("user_id", "zipcode", "confirmed_week").agg(F.min("since").alias("since"))


def day_state(feed: DataFrame, streak: DataFrame, pool: DataFrame, day) -> DataFrame:
    """Merged streak and pool rows at the end of the day, tagged ``kind``: to be written once by kind."""
    passed = day_pass(feed, streak, day, pool)
    both = streak_rows(passed).withColumn("kind", F.lit("streak"))
    return both.unionByName(pool_rows(passed).withColumn("kind", F.lit("pool")), allowMissingColumns=True)


def streak_merge(feed: DataFrame, streak: DataFrame, day) -> DataFrame:
    """Streaks at the end of the day: started, changed, continued and unseen ones."""
    return streak_rows(day_pass(feed, streak, day))


def pool_merge(feed: DataFrame, streak: DataFrame, pool: DataFrame, day) -> DataFrame:
    """Pool plus a week-0 row for every new or changed streak; earliest date kept."""
    return pool_rows(day_pass(feed, streak, day, pool))


# ---------------------------------------------------- closed form, no eviction

def route_without_eviction(annotated: DataFrame) -> DataFrame:
    """Route of every sighting when nobody is ever evicted."""
    after = F.col("ref_day").isNotNull() & (F.col("day") > F.col("ref_day"))
    away = after & (F.col("zipcode") != F.col("reference_zip"))
    x = annotated.withColumn("first_away", F.min(F.when(away, F.col("day"))).over(by_user()))
    route = (
        F.when(~after, F.lit(ROUTE_REFERENCE))
        .when(F.col("first_away").isNull() | (F.col("day") < F.col("first_away")), F.lit(ROUTE_HOME))
        .otherwise(F.lit(ROUTE_MOVER))
    )
    return x.withColumn("route", route)


def islands(movers: DataFrame, by: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Number the runs of equal zipcodes per user (or per ``by``) and add the running counters."""
    w = Window.partitionBy(*by).orderBy("day")
    changed = F.coalesce(F.lag("zipcode").over(w) != F.col("zipcode"), F.lit(True))
    x = movers.withColumn("island", F.sum(changed.cast("int")).over(w))
    wi = Window.partitionBy(*by, "island")
    wr = wi.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("streak_start", F.min("day").over(wi))
    x = x.withColumn("weekend_days", F.sum(weekend_flag("day")).over(wr).cast("bigint"))
    x = x.withColumn("weekday_days", F.sum(weekday_flag("day")).over(wr).cast("bigint"))
    return x.withColumn("age", inclusive_day_diff("day", "streak_start"))


def is_confirmed(th: Thresholds) -> Column:
    """An exact 7-day anniversary of the streak that passes the weekly test."""
    anniversary = (F.col("age") >= 7) & (F.col("age") % 7 == 0)
    we, sem = F.col("weekend_days"), F.col("weekday_days")
    return anniversary & week_passes(we, sem, we, sem, th)


def confirmed_anniversaries(isl: DataFrame, th: Thresholds) -> DataFrame:
    """Sightings on an exact 7-day anniversary of their streak that pass the weekly test."""
    return isl.where(is_confirmed(th)).withColumn(
        "confirmed_week", (F.col("age") / 7).cast("int")
    )


def mover_islands(annotated: DataFrame) -> DataFrame:
    """Mover sightings (no eviction) numbered into runs, with running counters and age."""
    movers = route_without_eviction(annotated).where(F.col("route") == ROUTE_MOVER)
    return islands(movers.select("user_id", "zipcode", "day", "reference_zip"))


def streak_from_islands(isl: DataFrame) -> DataFrame:
    """Current streak of every user: the last sighting of the last run."""
    last = isl.withColumn("last_day", F.max("day").over(by_user())).where(F.col("day") == F.col("last_day"))
    return last.select(
        "user_id", "zipcode", "streak_start", "weekend_days", "weekday_days",
        elapsed_weeks("day", "streak_start").alias("week_no"),
    )


def pool_from_islands(isl: DataFrame, th: Thresholds) -> DataFrame:
    """Pool rows: run starts (week 0) and confirmations away from the reference."""
    starts = isl.where(F.col("day") == F.col("streak_start")).select(
        "user_id", "zipcode", F.lit(0).alias("confirmed_week"), F.col("day").alias("since")
    )
    conf = confirmed_anniversaries(isl, th).where(F.col("zipcode") != F.col("reference_zip")).select(
        "user_id", "zipcode", "confirmed_week", F.col("day").alias("since")
    )
    return starts.unionByName(conf).groupBy("user_id", "zipcode", "confirmed_week").agg(
        F.min("since").alias("since")
    )


def mover_streak(annotated: DataFrame) -> DataFrame:
    """Current streak of every user, no eviction."""
    return streak_from_islands(mover_islands(annotated))


def mover_pool(annotated: DataFrame, th: Thresholds) -> DataFrame:
    """Pool rows, no eviction."""
    return pool_from_islands(mover_islands(annotated), th)
