"""Physical-plan guards for the scale properties the README claims."""

import re

from pyspark.sql import functions as F

from homeshift.config import FIXTURE_THRESHOLDS as TH, SNAPSHOT_DAY
from homeshift.operators import home_zip as hz
from homeshift.plans.movers import MoverRun, run_metrics
from homeshift.plans.snapshot import DayStep
from homeshift.sources import tables as tb
from places import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _dhz(spark):
    return hz.daily_home_zip_of_events(tb.table(spark, SF_SMALL, "events"))


def test_whole_run_has_one_exchange_on_users_and_no_python(spark):
    run = MoverRun(_dhz(spark), TH, horizon=tb.last_day(spark, SF_SMALL), materialize=False)
    p = _plan(run.states)
    hashed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    # hits by (user, day, zip), candidates by (user, day), then one row a user and day to its user
    assert [h.count("#") for h in hashed] == [1, 2, 3] and hashed[0].startswith("user_id#"), hashed
    assert "BroadcastExchange" not in p and "Python" not in p and "Arrow" not in p and "Join" not in p
    assert "partial_sum" in p and "partial_max" in p  # both levels of the home zip have their map-side step


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    for df in (_dhz(spark), hz.daily_home_zip(tb.visits(spark, SF_SMALL))):
        p = _plan(df)
        schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
        assert sorted(c.split(":")[0] for c in schema.split(",")) == ["props", "ts", "user_id"]
        assert "PushedFilters: [IsNotNull(user_id)]" in p


def test_final_tables_are_projections_of_the_states(spark):
    run = MoverRun(_dhz(spark), TH, horizon=tb.last_day(spark, SF_SMALL))
    for name in ("reference", "history", "registry", "pool", "streak", "evictions", "returned", "aged", "home_seen_in_pool", "potential_movers", "moves", "pool_profile"):
        p = _plan(getattr(run, name))
        assert "Exchange" not in p and "Join" not in p and "Python" not in p, (name, p)
    schema = re.search(r"ReadSchema: struct<(.*)>", _plan(run.reference)).group(1)
    assert "pool" not in schema and "audits" not in schema  # only the fields that the table needs


def test_day_step_reads_the_state_without_an_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = DayStep(_dhz(spark), SNAPSHOT_DAY, TH)
        assert "Exchange" not in _plan(d.compared)  # today's zips and references, both from the bucketed table
        assert "Exchange" not in _plan(d.routed_today) and "Join" not in _plan(d.streak_after)
        for df in (d.pool_evicted, d.streak_evicted):  # streak, pool and reference rows meet once
            assert _plan(df).count("Exchange hashpartitioning") == 1 and "Join" not in _plan(df), _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_metrics_read_the_input_once(spark, tmp_path):
    """The input is counted while the states are written: deleting it afterwards changes nothing."""
    import shutil

    copy = str(tmp_path / "events.parquet")
    shutil.copy(f"{SF_SMALL}/events.parquet", copy)
    ev = spark.read.parquet(copy)
    want = tb.visits_from_events(ev).count()
    last = ev.select(F.max(F.to_date("ts"))).first()[0]
    out = run_metrics(tb.visits_from_events(ev), TH, last, unique=True)
    shutil.move(copy, str(tmp_path / "moved"))
    assert dict(map(tuple, out.collect()))["visits_rows"] == want
    assert "events" not in _plan(out)


def test_workers_find_the_package_from_another_folder(tmp_path):
    """The stream's state processor run from another folder, with the package on the driver's path only."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from homeshift.config import FIXTURE_THRESHOLDS as TH
from homeshift.operators import home_zip as hz
from homeshift.session import local_session
from homeshift.sources import tables as tb
from homeshift.streaming import movers_stream as ms
s = local_session('2', extra={{'spark.sql.shuffle.partitions': '1'}})
dhz = hz.daily_home_zip_of_events(tb.table(s, {SF_SMALL!r}, 'events'))
print('ROWS', ms.stream_pool(ms.run_mover_stream(dhz, TH, chunk_days=400)).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 30" in out.stdout, out.stderr[-1500:]
