"""Batch job: visits (or raw events) -> every final table, written as parquet.

    python -m homeshift.plans.job --events /data/events --out /data/movers \
        [--horizon 2024-01-30] [--thresholds reference|fixture]

On a cluster: zip the ``homeshift`` package and run
``spark-submit --py-files homeshift.zip homeshift/plans/job.py ...``.

``--visits`` takes a table already counted per cookie, zipcode, time of day
and day (the reference's input); ``--events`` takes raw events.  Each
table goes to ``<out>/<name>``; the run fails rather than overwrite an
existing output folder.
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from homeshift.config import FIXTURE_THRESHOLDS, REFERENCE_THRESHOLDS, Thresholds
from homeshift.operators import home_zip as hz
from homeshift.plans.movers import MoverRun
from homeshift.session import clean_scratch, scratch_mark

OUTPUTS = ("reference", "history", "registry", "pool", "streak", "evictions", "returned", "aged", "home_seen_in_pool", "potential_movers", "moves")


def write_all(run: MoverRun, out_dir: str) -> dict[str, str]:
    paths = {}
    for name in OUTPUTS:
        path = f"{out_dir}/{name}"
        getattr(run, name).write.mode("error").parquet(path)
        paths[name] = path
    return paths


def run_job(spark: SparkSession, out_dir: str, th: Thresholds, visits_path: str | None = None,
            events_path: str | None = None, horizon: _dt.date | None = None,
            visits_table: str | None = None) -> dict[str, str]:
    if visits_path or visits_table:
        visits = spark.read.parquet(visits_path) if visits_path else spark.table(visits_table)
        last, dhz = visits.select(F.max("date")).scalar(), hz.daily_home_zip(visits)
    else:
        events = spark.read.parquet(events_path)
        last, dhz = events.select(F.max(F.to_date("ts"))).scalar(), hz.daily_home_zip_of_events(events)
    return write_all(MoverRun(dhz, th, horizon=horizon or last), out_dir)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--visits")
    src.add_argument("--visits-table", help="name of a table in the session catalog")
    src.add_argument("--events")
    ap.add_argument("--out", required=True)
    ap.add_argument("--horizon", type=_dt.date.fromisoformat)
    ap.add_argument("--thresholds", choices=["reference", "fixture"], default="reference")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("homeshift-movers").getOrCreate()
    th = REFERENCE_THRESHOLDS if a.thresholds == "reference" else FIXTURE_THRESHOLDS
    mark = scratch_mark()
    for name, path in run_job(spark, a.out, th, a.visits, a.events, a.horizon, a.visits_table).items():
        print(name, path)
    clean_scratch(spark, mark)


if __name__ == "__main__":
    main()
