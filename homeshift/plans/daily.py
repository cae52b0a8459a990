"""Daily incremental run: advance the state of the users seen today.

The state is one row a user (``operators.user_state``) in one table, partitioned by version and bucketed by user
(``StateStore``).  A day's version holds only the users that the day changed: those seen, and those whose pool age ran out.
A version counts once a manifest names it; the manifest is swapped last, by a rename that fails if another job was
first, so a job that broke off leaves nothing that is ever read and the day is simply run again.  ``compact`` writes one
version with all users and starts over from it.

Reading the state merges the versions: the last row of each user.  All versions of a bucket are read by one task, so
neither the merge nor the join with today's home zips moves the stored side; only today's rows are shuffled.

What must be recomputed each day (tenure and gap of every registry row) is derived on reading, so bytes written a day grow with
the users seen that day.  ``MoverRun`` computes the same tables over all days in one pass.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeshift.config import FIXTURE_THRESHOLDS, REFERENCE_THRESHOLDS, Thresholds
from homeshift.operators import user_state as us
from homeshift.operators.partitioning import user_partitions
from homeshift.session import path_exists
from homeshift.sources import catalog_tables as ct
from homeshift.sources import small_files as sf

COLUMNS = ", ".join(["user_id bigint", *(f"{k} {v}" for k, v in us.STATE.items())])
NO_AUDITS = [k for k in us.STATE if k != "audits"]


class StateStore:
    """Versions of the user states at ``path``; ``buckets`` is fixed by the first version."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.table = f"homeshift_state_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex[:16]}"
        self.manifest = self._last_manifest()
        self.buckets = self.manifest.get("buckets") or buckets or user_partitions(spark)
        if self.manifest["versions"]:
            ct.drop_table(spark, self.table)
            ct.attach(spark, self.table, f"{self.path}/versions", f"{COLUMNS}, version string", self.buckets, partition_by=["version"])

    # ------------------------------------------------------------------ manifest
    def _last_manifest(self) -> dict:
        names = sorted(n for n in sf.list_names(self.spark, f"{self.path}/manifest") if n.endswith(".json"))
        if not names:
            return {"number": 0, "versions": [], "days": []}
        return json.loads(sf.read_text(self.spark, f"{self.path}/manifest/{names[-1]}"))

    def _commit(self, versions: list[str], days: list[str]) -> None:
        number = self.manifest["number"] + 1
        new = {"number": number, "versions": versions, "days": days, "buckets": self.buckets}
        sf.write_once(self.spark, f"{self.path}/manifest/{number:08d}.json", json.dumps(new))
        self.manifest = new

    @property
    def last_day(self) -> _dt.date | None:
        return _dt.date.fromisoformat(self.manifest["days"][-1]) if self.manifest["days"] else None

    def _write(self, rows: DataFrame) -> str:
        """Rows (user_id, state fields) as a version that nothing names yet."""
        version = f"{self.manifest['number'] + 1:08d}-{uuid.uuid4().hex[:8]}"
        rows = rows.select("user_id", *us.STATE).withColumn("version", F.lit(version))
        ct.save_table(rows, self.table, f"{self.path}/versions", self.buckets, partition_by=["version"], mode="append")
        return version

    # --------------------------------------------------------------------- state
    def versions(self) -> DataFrame:
        """Rows of every version that counts; the others are pruned."""
        if not self.manifest["versions"]:
            return self.spark.createDataFrame([], f"{COLUMNS}, version string")
        return self.spark.table(self.table).where(F.col("version").isin(self.manifest["versions"]))

    def state(self) -> DataFrame:
        """(user_id, state fields without audits): the last row of each user."""
        last = F.max_by(F.struct(*NO_AUDITS), F.col("version"))
        return self.versions().groupBy("user_id").agg(last.alias("s")).select("user_id", "s.*")

    def audits(self, version: str | None = None) -> DataFrame:
        """Audit rows of a version (default: the last one)."""
        return us.audits(self.versions().where(F.col("version") == (version or self.manifest["versions"][-1])))

    def evictions(self, after: _dt.date) -> DataFrame:
        """Evictions of the days behind ``after`` from the versions that count: (user_id, day, reason, presence_days)."""
        rows = us.audits(self.versions()).where(F.col("day") > F.lit(after))
        return rows.select("user_id", "day", F.col("kind").alias("reason"), "presence_days").distinct()

    def reference(self) -> DataFrame:
        return us.reference(self.state())

    def history(self) -> DataFrame:
        return us.history(self.state())

    def registry(self) -> DataFrame:
        return us.registry(self.state(), F.lit(self.last_day))

    def streak(self) -> DataFrame:
        return us.streak(self.state())

    def pool(self) -> DataFrame:
        return us.pool(self.state())

    # ---------------------------------------------------------------------- work
    def load(self, states: DataFrame, day: _dt.date) -> None:
        """Start from the states at the end of ``day`` (such as ``MoverRun.states``)."""
        if self.manifest["versions"]:
            raise FileExistsError(f"{self.path} already holds a state")
        self._commit([self._write(states)], [day.isoformat()])

    def changes(self, home_zips: DataFrame, day: _dt.date, th: Thresholds) -> DataFrame:
        """(user_id, state fields) of the users that ``day`` changes; audits are the day's own."""
        d = F.lit(day)
        today = home_zips.where(F.col("day") == d).select("user_id", F.col("zipcode").alias("_zip"))
        x = self.state().join(today, "user_id", "full_outer")
        age_out = F.col("first").isNotNull() & (us.inclusive_day_diff(d, "first") > th.age_limit)
        x = x.where(F.col("_zip").isNotNull() | age_out)  # before any step: other users cost a read only
        fields = {k: F.coalesce(F.col(k), F.array().cast(t)) if t.startswith("array") else F.col(k) for k, t in us.STATE.items() if k != "audits"}
        old = F.struct(*[c.alias(k) for k, c in fields.items()], F.array().cast(us.STATE["audits"]).alias("audits")).cast(us.STATE_DDL)
        new = us.let(old, lambda s: F.when(F.col("_zip").isNotNull(), us.step(s, d, F.col("_zip"), th)).otherwise(us.aged_on(s, d, th)))
        return x.select("user_id", new.alias("s")).select("user_id", "s.*")

    def advance(self, home_zips: DataFrame, day: _dt.date, th: Thresholds) -> None:
        """Run one day: (user_id, zipcode, day) rows of any days, of which those of ``day`` count; one write."""
        if self.last_day is not None and day <= self.last_day:
            raise FileExistsError(f"{self.path} already holds the day {self.last_day}")
        version = self._write(self.changes(home_zips, day, th))
        self._commit([*self.manifest["versions"], version], [*self.manifest["days"], day.isoformat()])

    def compact(self) -> None:
        """One version with all users in place of all versions; the old files stay until ``sweep``."""
        if len(self.manifest["versions"]) > 1:
            whole = self.state().withColumn("audits", F.array().cast(us.STATE["audits"]))
            self._commit([self._write(whole)], self.manifest["days"][-1:])

    def sweep(self) -> list[str]:
        """Delete the folders of versions that no longer count, or never did; not while another job runs on the store."""
        keep = {f"version={v}" for v in self.manifest["versions"]}
        gone = [n for n in sf.list_names(self.spark, f"{self.path}/versions") if n.startswith("version=") and n not in keep]
        for n in gone:
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (version='{n.split('=', 1)[1]}')")
            sf.delete(self.spark, f"{self.path}/versions/{n}")
        return gone


def run_days(store: StateStore, home_zips: DataFrame, days: list[_dt.date], th: Thresholds, compact_every: int = 30) -> None:
    """Advance the store by the given days in order; days that it already holds are left out."""
    for day in sorted(days):
        if store.last_day is None or day > store.last_day:
            store.advance(home_zips, day, th)
            if len(store.manifest["versions"]) > compact_every:
                store.compact()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--state", required=True, help="folder of the state versions")
    ap.add_argument("--home-zips", required=True, help="daily home zips (user_id, zipcode, day), best partitioned by day")
    ap.add_argument("--day", required=True, action="append", type=_dt.date.fromisoformat, help="day to run; may be given several times")
    ap.add_argument("--compact-every", type=int, default=30)
    ap.add_argument("--thresholds", choices=["reference", "fixture"], default="reference")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("homeshift-daily").getOrCreate()
    th = REFERENCE_THRESHOLDS if a.thresholds == "reference" else FIXTURE_THRESHOLDS
    if not path_exists(spark, a.home_zips):
        raise FileNotFoundError(a.home_zips)
    run_days(StateStore(spark, a.state), spark.read.parquet(a.home_zips), a.day, th, a.compact_every)


if __name__ == "__main__":
    main()
