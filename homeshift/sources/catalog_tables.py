"""Catalog tables: bucketed by user, appended by name or by position, partitioned by day or version.

A table bucketed by ``user_id`` is read as hash-partitioned on it, so joins and aggregates on the user need no exchange of
the stored side.  A table that is partitioned and bucketed keeps that property over all of its partitions: a
bucket is read from all of them by one task.

Tables are external, at a given folder or a fresh one under ``spark.checkpoint.dir``.  A session without a lasting metastore
names them again with ``attach``; the files and their bucket numbers are enough.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from homeshift.operators.partitioning import user_partitions
from homeshift.session import scratch_path

BUCKET_KEY = "user_id"


def fresh_name(name: str) -> str:
    return f"homeshift_{name}_{uuid.uuid4().hex[:12]}"


def save_table(df: DataFrame, table: str, path: str | None = None, buckets: int | None = None, key: str = BUCKET_KEY,
               partition_by: list[str] | None = None, mode: str = "error") -> DataFrame:
    """Create (or append by name to) ``table``, bucketed and sorted by ``key``; return it as read from the catalog.

    Rows are dealt by the key into as many parts as there are buckets, so a bucket (of a partition) is one file.
    """
    spark = df.sparkSession
    n = buckets or user_partitions(spark)
    w = df.repartition(n, key).sortWithinPartitions(*(partition_by or []), key).write.mode(mode).format("parquet")
    w = w.bucketBy(n, key).sortBy(key)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if not spark.catalog.tableExists(table):
        w = w.option("path", path or scratch_path(spark, table))
    w.saveAsTable(table)
    return spark.table(table)


def append_by_name(df: DataFrame, table: str) -> DataFrame:
    """Append rows whose columns are matched by name, whatever their order."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.insertInto(table, overwrite=False)
    return spark.table(table)


def insert_by_position(df: DataFrame, table: str) -> DataFrame:
    """Append rows whose columns are matched by position, whatever their names.

    The number of columns must be the table's; a value that does not fit its column's type fails (ANSI store assignment).
    """
    spark = df.sparkSession
    want = spark.table(table).schema
    if len(df.columns) != len(want):
        raise ValueError(f"{len(df.columns)} columns for the {len(want)} of {table}")
    df.write.insertInto(table, overwrite=False)
    return spark.table(table)


def attach(spark: SparkSession, table: str, path: str, ddl: str, buckets: int, key: str = BUCKET_KEY, partition_by: list[str] | None = None) -> DataFrame:
    """Name the files of a table written by an earlier session again; ``ddl``: its columns, the partition columns last."""
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet {parts} CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def partitions_of(spark: SparkSession, table: str) -> DataFrame:
    """Partition values of a table from the catalog, one row each (``name=value`` text); no data file is read."""
    return spark.sql(f"SHOW PARTITIONS {table}")


def drop_table(spark: SparkSession, table: str) -> None:
    """Take the name away; the files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
