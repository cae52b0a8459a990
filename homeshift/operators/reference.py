"""Reference zipcode: closed form over all days, and the one-day operators.

Closed form.  Before a user has a reference, every sighting feeds the
reference history.  On a sighting day, the running count ``c`` of that zip
and the tenure ``t = day - first_seen + 1`` decide: the first day with
``c >= min_days`` and ``c / t >= min_share`` fixes the reference.  Only the
zip seen that day can newly qualify, and afterwards only the reference zip
keeps counting, so a user gets exactly one reference.  All of it is windows
partitioned by ``user_id`` (one hash exchange, bounded groups: one row per
user and day).

One-day operators.  They take today's home zips and the state tables of the
day before and return the next state, as the reference does every day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homeshift.config import Thresholds
from homeshift.functions.dates import inclusive_day_diff, weekday_flag, weekend_flag
from homeshift.functions.zips import zip_equal_flag
from homeshift.operators.partitioning import by_user_partitions

ROUTE_REFERENCE = "reference"   # no reference yet
ROUTE_HOME = "home"             # at the reference zip, not in the pool
ROUTE_MOVER = "mover"           # everything else


def by_user() -> Window:
    return Window.partitionBy("user_id")


def qualifies(days: Column, tenure: Column, th: Thresholds) -> Column:
    return (days >= th.min_days) & (days / (tenure * F.lit(1.0)) >= th.min_share)


def annotate(dhz: DataFrame, th: Thresholds) -> DataFrame:
    """Add first_seen, reference_zip and ref_day to every sighting.

    Windows partitioned by ``user_id`` (and ``user_id, zipcode``) over the
    explicit user partitioning: a single exchange for the whole per-user
    analysis; each window group is one user's days (bounded by the run length).
    """
    dhz = by_user_partitions(dhz)
    w_u = by_user()
    w_uz = (
        Window.partitionBy("user_id", "zipcode")
        .orderBy("day")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    x = dhz.withColumn("first_seen", F.min("day").over(w_u))
    x = x.withColumn("zip_days", F.count(F.lit(1)).over(w_uz))
    q = qualifies(F.col("zip_days"), inclusive_day_diff("day", "first_seen"), th)
    x = x.withColumn("ref", F.min(F.when(q, F.struct("day", "zipcode"))).over(w_u))
    return x.select(
        "user_id", "zipcode", "day", "first_seen",
        F.col("ref.zipcode").alias("reference_zip"),
        F.col("ref.day").alias("ref_day"),
    )


def reference_zip(annotated: DataFrame) -> DataFrame:
    """One row per user with a reference: (user_id, reference_zip, ref_day).

    The qualifying sighting is unique per user, so a filter replaces a group-by.
    """
    return annotated.where(F.col("day") == F.col("ref_day")).select("user_id", "reference_zip", "ref_day")


def is_pre_reference(day="day") -> Column:
    return F.col("ref_day").isNull() | (F.col(day) <= F.col("ref_day"))


# ---------------------------------------------------------------- one day

def compare_with_reference(today: DataFrame, ref: DataFrame) -> DataFrame:
    """Users of the day that have a reference, flagged 1 when home."""
    r = ref.select("user_id", "reference_zip").distinct()
    return today.join(r, "user_id", "inner").select(
        "user_id", "zipcode", zip_equal_flag("zipcode", "reference_zip").alias("matches_reference")
    )


def no_reference_yet(today: DataFrame, ref: DataFrame) -> DataFrame:
    return today.join(ref.select("user_id"), "user_id", "left_anti").select("user_id", "zipcode")


def pool_users(pool: DataFrame) -> DataFrame:
    """Users with a pool row; a row with a null zipcode counts as absent."""
    return pool.where(F.col("zipcode").isNotNull()).select("user_id").distinct()


def already_in_pool(compared: DataFrame, pool: DataFrame) -> DataFrame:
    return compared.join(pool_users(pool), "user_id", "left_semi")


def not_in_pool(compared: DataFrame, pool: DataFrame) -> DataFrame:
    return compared.join(pool_users(pool), "user_id", "left_anti")


def route_day(compared: DataFrame, pool: DataFrame) -> DataFrame:
    """Route each compared user: pool member -> mover, else home flag -> reference feed."""
    inp = pool_users(pool).withColumn("in_pool", F.lit(True))
    x = compared.join(inp, "user_id", "left")
    route = (
        F.when(F.col("in_pool").isNotNull(), F.lit(ROUTE_MOVER))
        .when(F.col("matches_reference") == 1, F.lit(ROUTE_HOME))
        .otherwise(F.lit(ROUTE_MOVER))
    )
    return x.select("user_id", "zipcode", "matches_reference", route.alias("route"))


def feeds(today: DataFrame, ref: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reference_feed, mover_feed) of one day."""
    routed = route_day(compare_with_reference(today, ref), pool)
    ref_feed = no_reference_yet(today, ref).unionByName(
        routed.where(F.col("route") == ROUTE_HOME).select("user_id", "zipcode")
    )
    mover_feed = routed.where(F.col("route") == ROUTE_MOVER).select("user_id", "zipcode").distinct()
    return ref_feed, mover_feed


def tag_day_counters(feed: DataFrame, day) -> DataFrame:
    d = F.lit(day)
    return feed.select(
        "user_id", "zipcode",
        weekend_flag(d).cast("bigint").alias("weekend_days"),
        weekday_flag(d).cast("bigint").alias("weekday_days"),
    )


def history_update(history: DataFrame, ref_feed: DataFrame, day) -> DataFrame:
    """Add one day of the reference feed to the (user, zip) day counters."""
    return (
        history.select("user_id", "zipcode", "weekend_days", "weekday_days")
        .unionByName(tag_day_counters(ref_feed, day))
        .groupBy("user_id", "zipcode")
        .agg(
            F.sum("weekend_days").cast("bigint").alias("weekend_days"),
            F.sum("weekday_days").cast("bigint").alias("weekday_days"),
        )
    )


def registry_update(registry: DataFrame, ref_feed: DataFrame, day) -> DataFrame:
    """Refresh tenure and gap of every user, then merge today's feed users."""
    d = F.lit(day)
    old = registry.select(
        "user_id", "last_seen", "first_seen",
        inclusive_day_diff(d, "last_seen").alias("gap_days"),
        inclusive_day_diff(d, "first_seen").alias("tenure_days"),
    )
    new = ref_feed.select(
        "user_id", d.alias("last_seen"), d.alias("first_seen"),
        F.lit(1).alias("gap_days"), F.lit(1).alias("tenure_days"),
    ).distinct()
    return old.unionByName(new).groupBy("user_id").agg(
        F.max("last_seen").alias("last_seen"),
        F.min("first_seen").alias("first_seen"),
        F.max("gap_days").alias("gap_days"),
        F.max("tenure_days").alias("tenure_days"),
    )


def history_with_totals(history: DataFrame) -> DataFrame:
    """Each (user, zip) row with its own total and the user's totals."""
    w = by_user()
    return history.select(
        "user_id", "zipcode", "weekend_days", "weekday_days",
        (F.col("weekend_days") + F.col("weekday_days")).alias("total_day_zip"),
        F.sum("weekend_days").over(w).cast("bigint").alias("total_weekend"),
        F.sum("weekday_days").over(w).cast("bigint").alias("total_weekday"),
    )


def reference_candidates(history: DataFrame, registry: DataFrame, th: Thresholds) -> DataFrame:
    """(user, zip) rows meeting the reference thresholds on this day."""
    h = history.select("user_id", "zipcode", (F.col("weekend_days") + F.col("weekday_days")).alias("total_day_zip"))
    x = h.join(registry.select("user_id", "tenure_days"), "user_id", "inner")
    return x.where(qualifies(F.col("total_day_zip"), F.col("tenure_days"), th)).select(
        "user_id", F.col("zipcode").alias("reference_zip")
    )
