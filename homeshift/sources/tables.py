"""Reads of the driver's tables and the visits rollup derived from ``events``.

The reference takes visits already counted per cookie, zipcode, time of day
and day.  The test data has raw ``events`` instead, so ``visits_from_events``
rolls them up with one partially aggregated group-by (map-side combine first,
then one hash exchange), which stays even when one cookie holds a large share
of the rows.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the visits fixture (see FIXTURES.md): hour bounds of the
# four time-of-day codes, the day the simulated movers move, and the zipcode
# rules of bad, trip, moved and home visits.
NIGHT_END_HOUR, MORNING_END_HOUR, WORK_END_HOUR = 6, 9, 18
MOVE_DAY = _dt.date(2024, 1, 13)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tranche_of_hour(h) -> F.Column:
    return (
        F.when(h < NIGHT_END_HOUR, F.lit(3))
        .when(h < MORNING_END_HOUR, F.lit(0))
        .when(h < WORK_END_HOUR, F.lit(1))
        .otherwise(F.lit(2))
    )


def visit_rows(events: DataFrame, *keep: str) -> DataFrame:
    """events(user_id, ts, props) -> one row per event: (cookie, zipcode, tranche, date, n, *keep)."""
    k = F.get_json_object("props", "$.k").cast("int")
    uid = F.col("user_id")
    day = F.to_date("ts")
    zipcode = (
        F.when(k < 3, F.lit("7500"))
        .when(k >= 90, (F.lit(69001) + k).cast("string"))
        .when((uid % 4 == 0) & (day >= F.lit(MOVE_DAY)), (F.lit(13001) + (uid * 11) % 900).cast("string"))
        .otherwise((F.lit(75001) + (uid * 37) % 900).cast("string"))
    )
    return events.select(
        *keep,
        uid.cast("string").alias("cookie"),
        zipcode.alias("zipcode"),
        tranche_of_hour(F.hour("ts")).alias("tranche"),
        day.alias("date"),
        (F.lit(1) + k % 5).alias("n"),
    )


def visits_from_events(events: DataFrame) -> DataFrame:
    """events(user_id, ts, props) -> visits(cookie, zipcode, tranche, date, nb_hits)."""
    return visit_rows(events).groupBy("cookie", "zipcode", "tranche", "date").agg(
        F.sum("n").cast("bigint").alias("nb_hits")
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits_from_events(table(spark, sf_dir, "events"))


def last_day(spark: SparkSession, sf_dir: str) -> F.Column:
    """Last day of the input as a scalar subquery over the one pruned ``ts`` column."""
    return table(spark, sf_dir, "events").select(F.max(F.to_date("ts"))).scalar()


def cast_visits(v: DataFrame) -> DataFrame:
    """(user_id, zipcode, nb_hits, tranche, day) with tolerant casts.

    A cookie that is not a number gives a null user_id (``try_cast``) instead
    of failing the job under ANSI mode.
    """
    return v.select(
        F.expr("try_cast(cookie AS BIGINT)").alias("user_id"),
        "zipcode",
        "nb_hits",
        F.expr("try_cast(tranche AS INT)").alias("tranche"),
        F.col("date").alias("day"),
    )


def scan_visits_distinct(v: DataFrame) -> DataFrame:
    """DISTINCT (user_id, zipcode, nb_hits, tranche, day)."""
    return cast_visits(v).distinct()


def scan_days(v: DataFrame, first: _dt.date | None = None, last: _dt.date | None = None) -> DataFrame:
    """Rows of a multi-day table from ``first`` to ``last`` (open ends by default); the bounds are pushed to the scan."""
    if first is not None:
        v = v.where(F.col("date") >= F.lit(first))
    if last is not None:
        v = v.where(F.col("date") <= F.lit(last))
    return v.select("cookie", "zipcode", "tranche", "nb_hits", "date")


def date_bounds(v: DataFrame) -> DataFrame:
    return v.agg(F.min("date").alias("date_min"), F.max("date").alias("date_max"))
