"""Weekly confirmation and eviction of one day.

All weeks are tested in one pass: a streak row is tested when its age is an
exact multiple of 7 and its week number equals age / 7, i.e. the user was seen
at that zip on the anniversary day (the week number only moves on sightings).

``end_of_day`` does the whole evening in one exchange: streak, pool and reference rows of a user meet, and windows over the
user decide confirmation, return home and age.  The single operators before it are the same steps one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homeshift.config import Thresholds
from homeshift.functions.dates import inclusive_day_diff
from homeshift.functions.zips import safe_share
from homeshift.operators.partitioning import by_user_partitions
from homeshift.operators.streak import POOL_COLS, STREAK_COLS, week_passes


def with_age(streak: DataFrame, day) -> DataFrame:
    return streak.withColumn("age", inclusive_day_diff(F.lit(day), "streak_start"))


def max_streak_age(streak: DataFrame, day) -> DataFrame:
    """Oldest streak and the number of weekly rounds it implies (kept distributed)."""
    return with_age(streak, day).agg(F.max("age").alias("max_age")).select(
        "max_age", F.floor(F.col("max_age") / 7).cast("int").alias("rounds")
    )


def anniversary_rows(streak: DataFrame, day) -> DataFrame:
    a = F.col("age")
    return with_age(streak, day).where((a >= 7) & (a % 7 == 0) & (F.col("week_no") == (a / 7).cast("int")))


def week_shares(streak: DataFrame) -> DataFrame:
    """Each streak row with the totals of its (user, week) and its shares of them."""
    w = Window.partitionBy("user_id", "week_no")
    x = streak.select(
        *STREAK_COLS,
        F.sum("weekend_days").over(w).cast("bigint").alias("total_weekend"),
        F.sum("weekday_days").over(w).cast("bigint").alias("total_weekday"),
    )
    return x.withColumn("share_weekend", safe_share("weekend_days", "total_weekend")).withColumn(
        "share_weekday", safe_share("weekday_days", "total_weekday")
    )


def week_confirmed(streak: DataFrame, day, th: Thresholds) -> DataFrame:
    """(user_id, zipcode, week_no) confirmed today."""
    x = anniversary_rows(week_shares(streak), day)  # shares of the whole week's totals, then the anniversaries
    ok = week_passes(F.col("weekend_days"), F.col("weekday_days"), F.col("total_weekend"), F.col("total_weekday"), th)
    return x.where(ok).groupBy("user_id", "week_no").agg(F.max("zipcode").alias("zipcode")).select(
        "user_id", "zipcode", "week_no"
    )


def confirmed_home(confirmed: DataFrame, ref: DataFrame) -> DataFrame:
    """Users whose confirmed zip is their reference: they came back."""
    r = ref.select(F.col("user_id").alias("u"), "reference_zip")
    at_home = (F.col("user_id") == F.col("u")) & (F.col("zipcode") == F.col("reference_zip"))
    return confirmed.join(r, at_home, "left_semi").select("user_id", "week_no")  # one zip a user and week


def confirmed_elsewhere(confirmed: DataFrame, ref: DataFrame, day) -> DataFrame:
    """Confirmed zips other than the reference become pool rows of that week."""
    r = ref.select("user_id", "reference_zip").distinct()
    return confirmed.join(r, "user_id", "inner").where(F.col("zipcode") != F.col("reference_zip")).select(
        "user_id", "zipcode", F.col("week_no").alias("confirmed_week"), F.lit(day).alias("since")
    )


def pool_age(pool: DataFrame, day) -> DataFrame:
    return pool.groupBy("user_id").agg(F.min("since").alias("date_min"), F.max("since").alias("date_max")).withColumn(
        "presence_days", inclusive_day_diff(F.lit(day), "date_min")
    )


def audit_returned_home(home: DataFrame, pool: DataFrame, day, th: Thresholds) -> DataFrame:
    x = home.join(pool_age(pool, day), "user_id", "inner").where(F.col("presence_days") <= th.return_limit)
    return x.select(
        "user_id", F.col("week_no").alias("week"), "date_min", "date_max", F.lit(day).alias("day"), "presence_days"
    )


def audit_aged_out(pool: DataFrame, day, th: Thresholds) -> DataFrame:
    w = Window.partitionBy("user_id")
    x = pool.select(*POOL_COLS, F.min("since").over(w).alias("date_min"), F.max("since").over(w).alias("date_max"))
    x = x.withColumn("presence_days", inclusive_day_diff(F.lit(day), "date_min")).where(
        F.col("presence_days") > th.age_limit
    )
    return x.select(*POOL_COLS, "date_min", "date_max", F.lit(day).alias("day"), "presence_days")


def evicted_users(home: DataFrame, pool: DataFrame, day, th: Thresholds) -> tuple[DataFrame, DataFrame]:
    returned = audit_returned_home(home, pool, day, th).select("user_id").distinct()
    aged = audit_aged_out(pool, day, th).select("user_id").distinct()
    return returned, aged


def pool_after_eviction(pool: DataFrame, elsewhere: DataFrame, returned: DataFrame, aged: DataFrame) -> DataFrame:
    return (
        pool.select(*POOL_COLS).unionByName(elsewhere.select(*POOL_COLS))
        .join(returned.select("user_id").unionByName(aged.select("user_id")), "user_id", "left_anti")
        .groupBy("user_id", "zipcode", "confirmed_week")
        .agg(F.min("since").alias("since"))
    )


def streak_after_eviction(streak: DataFrame, returned: DataFrame, aged: DataFrame) -> DataFrame:
    gone = returned.select("user_id").unionByName(aged.select("user_id"))
    return streak.select(*STREAK_COLS).join(gone, "user_id", "left_anti")


def pool_without(pool: DataFrame, elsewhere: DataFrame, users: DataFrame) -> DataFrame:
    """Pool and confirmed rows without some users' rows (one anti join), earliest date kept: the rule without an age limit."""
    rows = pool.select(*POOL_COLS).unionByName(elsewhere.select(*POOL_COLS)).join(users.select("user_id"), "user_id", "left_anti")
    return rows.groupBy("user_id", "zipcode", "confirmed_week").agg(F.min("since").alias("since"))


def streak_without(streak: DataFrame, users: DataFrame) -> DataFrame:
    """Streak rows without some users' rows (one anti join)."""
    return streak.select(*STREAK_COLS).join(users.select("user_id"), "user_id", "left_anti").distinct()


def end_of_day(passed: DataFrame, ref: DataFrame, day, th: Thresholds) -> DataFrame:
    """Streak and pool rows after confirmation and eviction, tagged ``kind``.

    ``passed``: the day's merged streak and pool rows (``streak.day_state``); ``ref``: (user_id, reference_zip).
    """
    d, kind = F.lit(day), F.col("kind")
    refs = ref.select("user_id", F.col("reference_zip").alias("zipcode")).distinct().withColumn("kind", F.lit("reference"))
    rows = by_user_partitions(passed.select("kind", *STREAK_COLS, "confirmed_week", "since").unionByName(refs, allowMissingColumns=True))
    user, week = Window.partitionBy("user_id"), Window.partitionBy("user_id", "kind", "week_no")
    total_we, total_sem = F.sum("weekend_days").over(week), F.sum("weekday_days").over(week)
    age = inclusive_day_diff(d, "streak_start")
    test = (kind == "streak") & (age >= 7) & (age % 7 == 0) & (F.col("week_no") == (age / 7).cast("int"))
    passes = test & week_passes(F.col("weekend_days"), F.col("weekday_days"), total_we, total_sem, th)
    rows = rows.withColumn("passes", F.coalesce(passes, F.lit(False)))
    confirmed = F.max(F.when(F.col("passes"), F.col("zipcode"))).over(week) == F.col("zipcode")
    rows = rows.withColumn("confirmed", F.col("passes") & confirmed)
    home = F.max(F.when(kind == "reference", F.col("zipcode"))).over(user)
    presence = inclusive_day_diff(d, F.min(F.when(kind == "pool", F.col("since"))).over(user))
    rows = rows.withColumn("home", home).withColumn("presence", presence)
    at_home = F.max(F.col("confirmed") & (F.col("zipcode") == F.col("home"))).over(user)
    gone = (at_home & (F.col("presence") <= th.return_limit)) | (F.col("presence") > th.age_limit)
    stay = rows.withColumn("gone", F.coalesce(gone, F.lit(False))).where("not gone and kind <> 'reference'")
    # a zip confirmed elsewhere is a pool row of its week beside the streak row
    elsewhere = F.col("confirmed") & (F.col("zipcode") != F.col("home"))
    tags = F.when(F.coalesce(elsewhere, F.lit(False)), F.array(F.lit("streak"), F.lit("new"))).otherwise(F.array("kind"))
    out = stay.withColumn("tag", F.explode(tags))
    new = F.col("tag") == "new"
    return out.select(
        F.when(new, F.lit("pool")).otherwise(F.col("tag")).alias("kind"), *STREAK_COLS,
        F.when(new, F.col("week_no")).otherwise(F.col("confirmed_week")).alias("confirmed_week"), F.when(new, d).otherwise(F.col("since")).alias("since"),
    )


def streak_at_end(ended: DataFrame) -> DataFrame:
    return ended.where("kind = 'streak'").select(*STREAK_COLS)


def pool_at_end(ended: DataFrame) -> DataFrame:
    return ended.where("kind = 'pool'").groupBy("user_id", "zipcode", "confirmed_week").agg(F.min("since").alias("since"))
