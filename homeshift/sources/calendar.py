"""Calendars, and which of their days have a table.

The reference lists day tables by name.  Here the committed days of ``day_tables.DayTables`` are a small table (day) read
from names alone, and "does the table of day d exist" is a semi join of a calendar against it: no data file is
read.  Calendars are bounded by their parameters (a few hundred days at most), never by the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homeshift.functions.dates import compact_day


def present_days(v: DataFrame, col: str = "date") -> DataFrame:
    return v.select(F.col(col).alias("day")).distinct()


def calendar_range(v: DataFrame, col: str = "date", pad: int = 0) -> DataFrame:
    """Every day from the first to the last day of the input (inclusive), padded."""
    b = v.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    seq = F.sequence(F.date_sub("lo", pad), F.date_add("hi", pad), F.expr("INTERVAL 1 DAY"))
    return b.select(F.explode(seq).alias("day")).select(
        "day", F.date_format("day", "yyyy-MM-dd").alias("day_dashed"), compact_day("day").alias("day_compact")
    )


def day_exists(days: DataFrame, pad: int = 2) -> DataFrame:
    """Every day from the first to the last table's day, padded, and whether it has a table."""
    cal = calendar_range(days, "day", pad).select("day")
    have = days.select("day").withColumn("exists", F.lit(True))
    return cal.join(have, "day", "left").select("day", F.coalesce("exists", F.lit(False)).alias("exists"))


def _lookback(days: DataFrame, n_days: int, gap: int) -> DataFrame:
    """Offsets gap+1 .. n_days-1 back from the day after the last table's day."""
    as_of = days.agg(F.date_add(F.max("day"), 1).alias("as_of"))
    off = as_of.select("as_of", F.explode(F.sequence(F.lit(gap + 1), F.lit(n_days - 1))).alias("offset"))
    return off.select("offset", F.date_sub("as_of", F.col("offset")).alias("day"))


def available_days(days: DataFrame, n_days: int = 50, gap: int = 2, cap: int | None = None) -> DataFrame:
    """Days of the look-back window that have a table, numbered oldest first; with ``cap`` only the cap + 1 newest."""
    newest = _lookback(days, n_days, gap).join(days.select("day"), "day", "left_semi")
    if cap is not None:
        newest = newest.orderBy("offset").limit(cap + 1)
    return newest.select(
        F.row_number().over(Window.orderBy("day")).alias("pos"), compact_day("day").alias("day_compact")
    )


def missing_days(days: DataFrame, n_days: int = 50, gap: int = 2) -> DataFrame:
    """Days of the look-back window without a table, numbered newest first."""
    cal = _lookback(days, n_days, gap).join(days.select("day"), "day", "left_anti")
    return cal.select(F.row_number().over(Window.orderBy("offset")).alias("pos"), compact_day("day").alias("day_compact"))
