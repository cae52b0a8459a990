"""Writers of the state tables.

Every table is written to a fresh folder under the shared checkpoint folder
(or a caller-given path), never over one of its own inputs: the reference's
"stage in a temp table, drop, recreate" becomes "write a new version".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from homeshift.session import scratch_path
from homeshift.sources.day_tables import DayTables


def write_table(df: DataFrame, path: str, mode: str = "error", partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def roundtrip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write once (create-table-as-select), read back."""
    path = write_table(df, scratch_path(spark, name))
    return spark.read.parquet(path)


def create_if_absent(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write the table unless it is there (create-table-if-not-exists-as-select): an existing one stays as it is."""
    write_table(df, path, mode="ignore")
    return spark.read.parquet(path)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write the table in place of an existing one, whatever its columns were."""
    write_table(df, path, mode="overwrite")
    return spark.read.parquet(path)


def append_parts(spark: SparkSession, parts: list[DataFrame], name: str) -> DataFrame:
    """First part creates the table, the others are appended by column name."""
    path = scratch_path(spark, name)
    cols = parts[0].columns
    for i, p in enumerate(parts):
        write_table(p.select(*cols), path, mode="error" if i == 0 else "append")
    return spark.read.parquet(path)


def split_by_day(spark: SparkSession, df: DataFrame, day_col: str, name: str, path: str | None = None, spread: int | None = None) -> DataFrame:
    """One folder per day in a single job (instead of one scan per day), at ``path`` or a fresh scratch folder.

    Days that are committed there are left as they are and all others are added, like the reference's CREATE TABLE
    IF NOT EXISTS for each day; see ``day_tables``.
    """
    days = DayTables(spark, path or scratch_path(spark, name), day_col)
    days.add_days(df, spread)
    return days.read(df.schema)
