"""The one partitioning every per-user step shares."""

from __future__ import annotations

from pyspark.sql import DataFrame


def by_user_partitions(df: DataFrame) -> DataFrame:
    """Hash-partition on user_id into ``spark.sql.shuffle.partitions`` parts.

    An explicit count keeps AQE from coalescing the (small in bytes, but heavy in work)
    per-user stage into a handful of tasks.  The replay of the states, the reference windows and the
    one-day passes run on this partitioning, and stored states are bucketed by it.
    """
    return df.repartition(user_partitions(df.sparkSession), "user_id")


def user_partitions(spark) -> int:
    """Parts of the user exchange: ``homeshift.user.partitions`` of the session, else the shuffle partitions."""
    value = spark.conf.get("homeshift.user.partitions", None) or spark.conf.get("spark.sql.shuffle.partitions")
    if not str(value).isdigit():
        raise ValueError(f"set homeshift.user.partitions to a number (spark.sql.shuffle.partitions is {value!r})")
    return int(value)
