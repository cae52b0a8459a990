"""Daily home zipcode of each user (one row per user and day).

Rule: distinct visit rows, 5-character zipcodes only, all hours on weekend
days and only the home hours (tranche 2 or 3) on working days; sum hits per
zipcode, keep the largest sum, break ties by the largest zipcode.

Plan: two levels, each with a map-side partial step.  Hits are added up per (user, day, zip), so a cookie with a third of
all rows and many zips is spread over its zips; the arg-max per (user, day) is ``max`` of a (hits, zipcode)
struct, which orders exactly like the rule, instead of the reference's aggregate + self-join + second aggregate, and a
task sends one candidate a user and day.  No row of a user travels by ``user_id`` before it is one a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeshift.functions.dates import is_weekend
from homeshift.functions.zips import home_hours_label, is_home_hours, is_valid_zip, HOME_LABEL
from homeshift.sources.tables import cast_visits, scan_visits_distinct, visit_rows


def valid_visits(v: DataFrame, unique: bool = False) -> DataFrame:
    """Distinct rows with a usable user id and a valid zipcode."""
    rows = cast_visits(v) if unique else scan_visits_distinct(v)
    return rows.where(F.col("user_id").isNotNull() & is_valid_zip("zipcode"))


def label_home_hours(v: DataFrame) -> DataFrame:
    return valid_visits(v).withColumn("hours", home_hours_label("tranche"))


def filter_home_hours(v: DataFrame) -> DataFrame:
    return label_home_hours(v).where(F.col("hours") == HOME_LABEL).drop("hours")


def home_rows(v: DataFrame, weekend: bool | None = None, unique: bool = False) -> DataFrame:
    """Rows that count for the home zip; ``weekend`` limits to one kind of day."""
    rows = valid_visits(v, unique)
    we = is_weekend("day")
    if weekend is True:
        return rows.where(we)
    if weekend is False:
        return rows.where(~we & is_home_hours("tranche"))
    return rows.where(we | is_home_hours("tranche"))


def hits_per_user_zip(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "day", "zipcode").agg(F.sum("nb_hits").alias("nb_page"))


def max_hits_per_user(hits: DataFrame) -> DataFrame:
    return hits.groupBy("user_id", "day").agg(F.max("nb_page").alias("max_page"))


def argmax_zip(hits: DataFrame) -> DataFrame:
    """Most hits, then largest zip, of each user and day: (user_id, zipcode, day, nb_page)."""
    best = (
        hits.where(F.col("nb_page").isNotNull())
        .groupBy("user_id", "day")
        .agg(F.max(F.struct("nb_page", "zipcode")).alias("best"))
    )
    return best.select("user_id", F.col("best.zipcode").alias("zipcode"), "day", F.col("best.nb_page").alias("nb_page"))


def daily_home_zip(v: DataFrame, weekend: bool | None = None, unique: bool = False) -> DataFrame:
    """visits -> (user_id, zipcode, day).

    ``unique``: the rows are a rollup of their own (no copies), so the distinct is left out.
    """
    return argmax_zip(hits_per_user_zip(home_rows(v, weekend, unique))).select("user_id", "zipcode", "day")


def daily_home_zip_of_events(events: DataFrame) -> DataFrame:
    """events -> (user_id, zipcode, day), the same rows as through the visits, without building them.

    A rollup has one row a (cookie, zip, time of day, day), so adding up its distinct rows is adding up the events.
    """
    rows = visit_rows(events).select(
        F.expr("try_cast(cookie AS BIGINT)").alias("user_id"), "zipcode", F.col("n").cast("bigint").alias("nb_hits"), "tranche", F.col("date").alias("day")
    )
    counted = rows.where(F.col("user_id").isNotNull() & is_valid_zip("zipcode") & (is_weekend("day") | is_home_hours("tranche")))
    return argmax_zip(hits_per_user_zip(counted)).select("user_id", "zipcode", "day")
