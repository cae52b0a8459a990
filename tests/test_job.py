"""The batch job writes every final table; counts match the golden values at sf0.001."""

from homeshift.config import FIXTURE_THRESHOLDS as TH
from homeshift.plans.job import OUTPUTS, run_job
from homeshift.session import scratch_path
from places import SF_SMALL


def test_job_from_events_writes_all_tables(spark):
    out = scratch_path(spark, "job")
    paths = run_job(spark, out, TH, events_path=f"{SF_SMALL}/events.parquet")
    assert sorted(paths) == sorted(OUTPUTS)
    n = {k: spark.read.parquet(p).count() for k, p in paths.items()}
    assert (n["reference"], n["history"], n["streak"], n["pool"], n["moves"]) == (15, 22, 11, 30, 2)
    assert n["potential_movers"] == 14


def test_job_cli_from_visits_table(spark):
    from homeshift.plans.job import main
    from homeshift.sources import tables as tb

    visits = scratch_path(spark, "visits")
    tb.visits(spark, SF_SMALL).write.parquet(visits)
    out = scratch_path(spark, "job-cli")
    main(["--visits", visits, "--out", out, "--thresholds", "fixture"])
    assert spark.read.parquet(f"{out}/moves").count() == 2


def test_horizon_bounds_the_run(spark):
    """A run with a horizon equals a run on data up to that day."""
    import datetime as dt

    from homeshift.operators import home_zip as hz
    from homeshift.plans.movers import MoverRun
    from homeshift.sources import tables as tb

    dhz, h = hz.daily_home_zip(tb.visits(spark, SF_SMALL)), dt.date(2024, 1, 15)
    cut = MoverRun(dhz.where("day <= DATE'2024-01-15'"), TH, horizon=h)
    run = MoverRun(dhz, TH, horizon=h)
    for name in ("pool", "streak", "registry", "history"):
        assert sorted(map(str, getattr(run, name).collect())) == sorted(map(str, getattr(cut, name).collect())), name
    assert run.registry.where("gap_days < 0").count() == 0


def test_audits_have_their_columns(spark):
    from homeshift.operators import home_zip as hz
    from homeshift.plans.movers import MoverRun
    from homeshift.sources import tables as tb

    run = MoverRun(hz.daily_home_zip(tb.visits(spark, SF_SMALL)), TH.with_(age_limit=12))
    assert run.aged.columns == ["user_id", "zipcode", "confirmed_week", "since", "date_min", "date_max", "day", "presence_days"]
    assert run.aged.count() > 0 and run.aged.where("presence_days <= 12 or since < date_min").count() == 0


def test_job_from_a_catalog_table_removes_only_its_own_scratch(spark):
    from homeshift.plans.job import main
    from homeshift.session import materialize, path_exists, scratch_mark
    from homeshift import session
    from homeshift.sources import tables as tb

    other = materialize(spark.range(3), "other")
    tb.visits(spark, SF_SMALL).createOrReplaceTempView("job_visits")
    out = scratch_path(spark, "job-table")
    mark = scratch_mark()
    main(["--visits-table", "job_visits", "--out", out, "--thresholds", "fixture"])
    assert scratch_mark() == mark and path_exists(spark, session._SCRATCH[-1])
    assert spark.read.parquet(f"{out}/moves").count() == 2 and other.count() == 3
