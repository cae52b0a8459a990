"""One folder a day under a common path, each day committed on its own.

``add_days`` writes the days that are not committed yet in one job to a staging folder, then moves day after day into place and writes
the day's marker last.  A day counts only with its marker: a job that broke off leaves days without one, which are neither read
nor listed and are replaced when the job runs again; finished days are not written and, as the filter on the day
is pushed to the input, not read.  Which days there are comes from the markers' names, never from data.

``read_days`` reads many day folders at once, whatever the order and the types of their columns: folders of equal
types are one scan, and the scans are united by name with tolerant casts.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homeshift.functions.dates import compact_day
from homeshift.sources import small_files as sf

MARKERS = "_days"


class DayTables:
    def __init__(self, spark: SparkSession, path: str, day_col: str = "date"):
        self.spark, self.path, self.day_col = spark, path.rstrip("/"), day_col

    # ------------------------------------------------------------------ metadata
    def day_list(self) -> list[_dt.date]:
        """Committed days in order: names of markers, one a day."""
        return sorted(_dt.date.fromisoformat(n) for n in sf.list_names(self.spark, f"{self.path}/{MARKERS}") if not n.startswith("."))

    def days(self) -> DataFrame:
        """Committed days as a table (day)."""
        return self.spark.createDataFrame([(d,) for d in self.day_list()], "day date")

    def exists(self, day: _dt.date) -> bool:
        """Whether the table of exactly this day is there."""
        return day.isoformat() in sf.list_names(self.spark, f"{self.path}/{MARKERS}")

    def folder(self, day: _dt.date) -> str:
        return f"{self.path}/{self.day_col}={day.isoformat()}"

    # --------------------------------------------------------------------- write
    def stage(self, df: DataFrame, spread: int | None = None) -> str:
        """Write the rows of days that are not committed to a staging folder.

        Rows are dealt by day and rebalanced to the advisory partition size, so a day of any size is files of that size (a hot
        day is split, small ones share a task); with ``spread`` every day is dealt into that many parts instead.
        """
        have = self.day_list()
        rows = df.where(F.col(self.day_col).isNotNull())
        if have:
            rows = rows.where(~F.col(self.day_col).isin(have))
        staging = f"{self.path}/_staging-{uuid.uuid4().hex[:12]}"
        dealt = rows.hint("rebalance", self.day_col) if spread is None else rows.repartition(self.day_col, F.pmod(F.xxhash64(*df.columns), F.lit(spread)))
        dealt.write.partitionBy(self.day_col).parquet(staging)
        return staging

    def commit(self, staging: str) -> list[_dt.date]:
        """Move staged days into place, each with its marker last; a leftover without marker is replaced."""
        done = []
        for name in sorted(sf.list_names(self.spark, staging)):
            if not name.startswith(f"{self.day_col}="):
                continue
            day = _dt.date.fromisoformat(name.split("=", 1)[1])
            if self.exists(day):  # another job was first
                continue
            sf.delete(self.spark, self.folder(day))
            sf.move(self.spark, f"{staging}/{name}", self.folder(day))
            sf.write_once(self.spark, f"{self.path}/{MARKERS}/{day.isoformat()}", "")
            done.append(day)
        sf.delete(self.spark, staging)
        return done

    def add_days(self, df: DataFrame, spread: int | None = None) -> list[_dt.date]:
        """Add the days of ``df`` that are not committed yet; returns them."""
        return self.commit(self.stage(df, spread))

    # ---------------------------------------------------------------------- read
    def read(self, schema: T.StructType, days: list[_dt.date] | None = None) -> DataFrame:
        """Committed days (or those of ``days`` that are committed) whose files have the columns of ``schema``; integers may be narrower."""
        want = [d for d in self.day_list() if days is None or d in set(days)]
        if not want:
            return self.spark.createDataFrame([], schema)
        got = self.spark.read.schema(schema).option("basePath", self.path).parquet(*[self.folder(d) for d in want])
        return got.select(*schema.fieldNames())

    def read_where(self, schema: T.StructType, days: DataFrame) -> DataFrame:
        """Rows of the days of another table (day): the folders to read are found while the query runs (dynamic partition pruning)."""
        known = days.where(F.col("day").isin(self.day_list())).select(F.col("day").alias(self.day_col)).distinct()  # at most one row a folder
        return self.read(schema).join(F.broadcast(known), self.day_col, "left_semi").select(*schema.fieldNames())

    def read_days(self, schema: T.StructType, days: list[_dt.date] | None = None) -> DataFrame:
        """Rows of many day folders whose columns differ in order and type, tagged with their day as ``day1`` (yyyyMMdd).

        Folders are grouped by the types in their footers (one is read a day); a value that can't be cast is null, a
        missing column too.
        """
        groups: dict[str, tuple[T.StructType, list[str]]] = {}
        for d in self.day_list():
            if days is None or d in set(days):
                own = self.spark.read.parquet(self.folder(d)).schema
                groups.setdefault(own.json(), (own, []))[1].append(self.folder(d))
        out = None
        for own, folders in groups.values():
            rows = self.spark.read.schema(own).option("basePath", self.path).parquet(*folders)
            have = set(rows.columns)
            rows = rows.select(*[
                (F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})") if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields
            ])
            out = rows if out is None else out.unionByName(rows)
        out = self.spark.createDataFrame([], schema) if out is None else out
        return out.withColumn("day1", compact_day(self.day_col))
