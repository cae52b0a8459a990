"""Registry of named queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's ``events`` table (through the visits rollup)
and runs over all of it.  One-day operators run on ``SNAPSHOT_DAY`` against
the state of the day before (see ``plans.snapshot``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homeshift.config import FIRST_DAY, FIXTURE_THRESHOLDS as TH, LATE_DAY, RUN_AGE_LIMIT, SNAPSHOT_AGE_LIMIT, SNAPSHOT_DAY, WEEKEND_DAY
from homeshift import schemas
from homeshift.operators import confirm as cf
from homeshift.operators import home_zip as hz
from homeshift.operators import reference as rf
from homeshift.operators import streak as sk
from homeshift.plans.daily import StateStore, run_days
from homeshift.plans.movers import MoverRun, run_metrics
from homeshift.plans.snapshot import DayStep
from homeshift.functions import dates as dt
from homeshift.functions import zips as zp
from homeshift.session import materialize, scratch_path
from homeshift.sources import calendar as cal
from homeshift.sources import catalog_tables as ct
from homeshift.sources import sinks
from homeshift.sources import tables as tb
from homeshift.sources.day_tables import DayTables
from homeshift.streaming import movers_stream as ms

Query = Callable[[SparkSession, str], DataFrame]
TH_AGED = TH.with_(age_limit=RUN_AGE_LIMIT)
TH_SNAPSHOT = TH.with_(age_limit=SNAPSHOT_AGE_LIMIT)


def _visits(spark, sf):
    return tb.visits(spark, sf)


def _dhz(spark, sf):
    return hz.daily_home_zip_of_events(tb.table(spark, sf, "events"))


def _annotated(spark, sf):
    return rf.annotate(_dhz(spark, sf), TH)


def _step(spark, sf, day=SNAPSHOT_DAY) -> DayStep:
    return DayStep(_dhz(spark, sf), day, TH_SNAPSHOT)


def _run(spark, sf, th=TH) -> MoverRun:
    return MoverRun(_dhz(spark, sf), th, horizon=tb.last_day(spark, sf))


def _on_run(fn, th=TH) -> Query:
    return lambda spark, sf: fn(_run(spark, sf, th))


def _on_step(fn, day=SNAPSHOT_DAY) -> Query:
    return lambda spark, sf: fn(_step(spark, sf, day))


def _table_twice(sink) -> Query:
    """The weekend's home zips written by ``sink``, then all home zips by the same sink at the same place."""
    def run(spark, sf):
        path = scratch_path(spark, "table-twice")
        sink(spark, hz.daily_home_zip(_visits(spark, sf), weekend=True), path)
        return sink(spark, _dhz(spark, sf), path)

    return run


# Newest days kept by the capped look-back, less one.
DAYS_CAP = 9

# Days by which a sighting comes late in the query on late rows: ten for about one in fifty.
LATE_BY = "CASE WHEN pmod(xxhash64(day, user_id), 50) = 0 THEN 10 ELSE 0 END"

# Fixed value: zipcode fragment of the LIKE filter ('_' would match any character).
LIKE_FRAGMENT = "7500"


# Name under which the visits are known to the session catalog.
VISITS_NAME = "homeshift_visits"


def _saved_visits(spark, sf) -> DataFrame:
    """The visits as a catalog table of their own, bucketed by cookie."""
    return ct.save_table(_visits(spark, sf), ct.fresh_name("visits"), key="cookie")


def _day_tables(spark, sf) -> DayTables:
    """The visits split into one table a day."""
    days = DayTables(spark, scratch_path(spark, "visits-by-day"))
    days.add_days(_visits(spark, sf))
    return days


def _home_zip_days(spark, sf) -> DayTables:
    """The daily home zips, one table a day."""
    days = DayTables(spark, scratch_path(spark, "home-zip-by-day"), "day")
    days.add_days(_dhz(spark, sf))
    return days


def _on_days(fn) -> Query:
    return lambda spark, sf: fn(_day_tables(spark, sf).days())


def _weekend_days(spark, sf):
    """Rows of the weekend's day tables; the folders are found while the query runs."""
    days = _home_zip_days(spark, sf)
    return days.read_where(schemas.DAILY_HOME_ZIP, days.days().where(dt.is_weekend("day")))


def _references_by_position(spark, sf):
    """References fixed before the snapshot day as a table; the later ones appended by position, under other names."""
    x = _annotated(spark, sf).where(F.col("day") == F.col("ref_day"))
    early = x.where(F.col("ref_day") < F.lit(SNAPSHOT_DAY))
    table = ct.fresh_name("reference_zip")
    ct.save_table(early.select("user_id", "reference_zip", "ref_day"), table)
    late = x.where(F.col("ref_day") >= F.lit(SNAPSHOT_DAY))
    return ct.insert_by_position(late.select("user_id", F.col("zipcode").alias("ref_day"), F.col("day").alias("reference_zip")), table)


#: Days that the daily job runs one by one, on top of a state loaded from the whole run before them.
LAST_DAYS = 3


def _daily_store(spark, sf, th) -> StateStore:
    """State of the whole run up to LAST_DAYS days before its end, then the daily job for each of those days."""
    dhz = materialize(_dhz(spark, sf), "daily-home-zips")
    last = dhz.agg(F.max("day")).first()[0]  # one date
    store = StateStore(spark, scratch_path(spark, "state"))
    if last is not None:
        start = last - _dt.timedelta(days=LAST_DAYS)
        store.load(MoverRun(dhz, th, horizon=start).states, start)
        run_days(store, dhz, [start + _dt.timedelta(days=i + 1) for i in range(LAST_DAYS)], th)
    return store


def _last_evictions(store: StateStore) -> DataFrame:
    """Evictions of the days that the daily job ran."""
    return store.evictions((store.last_day or SNAPSHOT_DAY) - _dt.timedelta(days=LAST_DAYS))


def _named(spark, sf) -> SparkSession:
    _visits(spark, sf).createOrReplaceTempView(VISITS_NAME)
    return spark


def _days(spark, sf):
    return cal.present_days(_visits(spark, sf))


def _spans(spark, sf):
    return _dhz(spark, sf).groupBy("user_id").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def _safe_share(spark, sf):
    hits = hz.hits_per_user_zip(hz.home_rows(_visits(spark, sf)))
    total = F.sum("nb_page").over(Window.partitionBy("user_id", "day"))
    return hits.withColumn("total", total).select(
        "user_id", "day", "zipcode", "nb_page", zp.safe_share("nb_page", "total").alias("share")
    )


def _date_parts(spark, sf):
    d = _days(spark, sf).select(F.date_format("day", "yyyy-MM-dd").alias("dashed"), dt.compact_day("day").alias("compact"))
    a, b = dt.parse_day("dashed"), dt.parse_day("compact")
    return d.select(
        "dashed", "compact", F.year(a).alias("year"), F.month(a).alias("month"), F.dayofmonth(a).alias("day_of_month"),
        F.year(b).alias("c_year"), F.month(b).alias("c_month"), F.dayofmonth(b).alias("c_day_of_month"),
    )


def build() -> dict[str, Query]:
    q: dict[str, Query] = {}
    # ---- sources and the daily home zip
    q["visits_from_events"] = _visits
    q["daily_home_zip"] = _dhz
    q["daily_home_zip_weekend"] = lambda s, sf: hz.daily_home_zip(_visits(s, sf), weekend=True)
    q["daily_home_zip_weekday"] = lambda s, sf: hz.daily_home_zip(_visits(s, sf), weekend=False)
    q["scan_visits_distinct"] = lambda s, sf: tb.scan_visits_distinct(_visits(s, sf))
    q["hits_per_user_zip"] = lambda s, sf: hz.hits_per_user_zip(hz.home_rows(_visits(s, sf)))
    q["max_hits_per_user"] = lambda s, sf: hz.max_hits_per_user(hz.hits_per_user_zip(hz.home_rows(_visits(s, sf))))
    q["argmax_zip"] = lambda s, sf: hz.argmax_zip(hz.hits_per_user_zip(hz.home_rows(_visits(s, sf))))
    q["filter_valid_zip"] = lambda s, sf: hz.valid_visits(_visits(s, sf))
    q["label_home_hours"] = lambda s, sf: hz.label_home_hours(_visits(s, sf))
    q["filter_home_hours"] = lambda s, sf: hz.filter_home_hours(_visits(s, sf))

    q["scan_visits_all"] = lambda s, sf: _day_tables(s, sf).read(schemas.VISITS)
    q["scan_catalog_table"] = _saved_visits
    q["named_relation_sql"] = lambda s, sf: _named(s, sf).sql(
        f"SELECT zipcode, count(DISTINCT cookie) AS users, sum(nb_hits) AS hits FROM {VISITS_NAME} GROUP BY zipcode"
    )
    q["project_cast"] = lambda s, sf: _visits(s, sf).select(
        F.expr("try_cast(cookie AS BIGINT)").alias("user_id"), "zipcode", "nb_hits",
        F.expr("try_cast(tranche AS INT)").alias("tranche"), "date",
    )
    q["load_days_tagged"] = lambda s, sf: _day_tables(s, sf).read_days(schemas.VISITS)
    q["date_bounds"] = lambda s, sf: tb.date_bounds(_visits(s, sf))
    q["distinct_projection"] = lambda s, sf: _dhz(s, sf).select("user_id", "zipcode").distinct()
    q["filter_like"] = lambda s, sf: _visits(s, sf).select("zipcode").distinct().where(
        F.col("zipcode").like("%" + LIKE_FRAGMENT + "%")
    )
    q["safe_share"] = _safe_share
    q["calendar_range"] = lambda s, sf: cal.calendar_range(_visits(s, sf))
    q["day_exists"] = _on_days(cal.day_exists)
    q["available_days"] = _on_days(cal.available_days)
    q["available_days_capped"] = _on_days(lambda d: cal.available_days(d, cap=DAYS_CAP))
    q["missing_days"] = _on_days(cal.missing_days)
    q["scan_weekend_days"] = _weekend_days
    q["date_parts"] = _date_parts
    q["weekend_label"] = lambda s, sf: _days(s, sf).select("day", dt.weekend_label("day").alias("label"))
    q["weekday_name"] = lambda s, sf: _days(s, sf).select("day", dt.weekday_name("day").alias("day_name"))
    q["format_day"] = lambda s, sf: _days(s, sf).select(dt.compact_day("day").alias("c")).select(
        F.col("c").alias("day_compact"), dt.format_day("c", "-").alias("day_dashed"),
        dt.format_day("c", "/").alias("day_slashed"),
    )
    q["day_before"] = lambda s, sf: _days(s, sf).select(dt.compact_day("day").alias("c")).select(
        F.col("c").alias("day_compact"), dt.day_before("c", 1).alias("day_before_1"),
        dt.day_before("c", 7).alias("day_before_7"),
    )
    q["inclusive_day_diff"] = lambda s, sf: _spans(s, sf).select(
        "user_id", "first_day", "last_day", dt.inclusive_day_diff("last_day", "first_day").alias("span_days")
    )
    q["elapsed_weeks"] = lambda s, sf: _spans(s, sf).select(
        "user_id", dt.elapsed_weeks("last_day", "first_day").alias("weeks")
    )
    q["zip_equal_flag"] = lambda s, sf: _annotated(s, sf).where("reference_zip is not null").select("user_id", "day", "zipcode", zp.zip_equal_flag("zipcode", "reference_zip").alias("matches_reference"))
    q["sink_roundtrip"] = lambda s, sf: sinks.roundtrip(s, _dhz(s, sf), "daily_home_zip")
    q["sink_append"] = lambda s, sf: sinks.append_parts(
        s, [hz.daily_home_zip(_visits(s, sf), weekend=True), hz.daily_home_zip(_visits(s, sf), weekend=False)],
        "daily_home_zip_append",
    )
    q["sink_create_if_absent"] = _table_twice(sinks.create_if_absent)
    q["sink_overwrite"] = _table_twice(sinks.replace_table)
    q["sink_insert_by_position"] = _references_by_position
    q["split_by_day"] = lambda s, sf: sinks.split_by_day(s, _visits(s, sf), "date", "visits_by_day")

    # ---- reference, closed form over all days
    q["reference_zip"] = lambda s, sf: rf.reference_zip(_annotated(s, sf))
    q["mover_streak"] = lambda s, sf: sk.mover_streak(_annotated(s, sf))
    q["mover_pool"] = lambda s, sf: sk.mover_pool(_annotated(s, sf), TH)

    # ---- one day on the snapshot state
    q["scan_day_partition"] = lambda s, sf: _home_zip_days(s, sf).read(schemas.DAILY_HOME_ZIP, [SNAPSHOT_DAY])
    q["compare_with_reference"] = _on_step(lambda d: d.compared)
    q["no_reference_yet"] = _on_step(lambda d: rf.no_reference_yet(d.today, d.ref))
    q["already_in_pool"] = _on_step(lambda d: rf.already_in_pool(d.compared, d.pool))
    q["not_in_pool"] = _on_step(lambda d: rf.not_in_pool(d.compared, d.pool))
    q["route_day"] = _on_step(lambda d: rf.route_day(d.compared, d.pool))
    q["tag_constants"] = _on_step(lambda d: rf.tag_day_counters(d.reference_feed, d.day))
    q["history_update"] = _on_step(lambda d: d.history_after)
    q["registry_update"] = _on_step(lambda d: d.registry_after)
    q["derive_total_days"] = _on_step(
        lambda d: d.history_after.withColumn("total_day_zip", F.col("weekend_days") + F.col("weekday_days"))
    )
    q["history_with_totals"] = _on_step(lambda d: rf.history_with_totals(d.history_after))
    q["reference_candidates"] = _on_step(lambda d: rf.reference_candidates(d.history_after, d.registry_after, d.th))
    q["streak_new"] = _on_step(lambda d: sk.streak_new(d.mover_feed, d.streak, d.day))
    q["streak_continued"] = _on_step(lambda d: sk.streak_continued(d.mover_feed, d.streak, d.day))
    q["streak_changed"] = _on_step(lambda d: sk.streak_changed(d.mover_feed, d.streak, d.day))
    q["streak_unseen"] = _on_step(lambda d: sk.streak_unseen(d.mover_feed, d.streak))
    q["streak_other_zip"] = _on_step(lambda d: sk.streak_other_zip(d.mover_feed, d.streak))
    q["streak_merge"] = _on_step(lambda d: d.streak_after)
    q["pool_merge"] = _on_step(lambda d: d.pool_after)
    q["max_streak_age"] = _on_step(lambda d: cf.max_streak_age(d.streak_after, d.day))
    q["anniversary_rows"] = _on_step(lambda d: cf.anniversary_rows(d.streak_after, d.day))
    q["week_shares"] = _on_step(lambda d: cf.week_shares(d.streak_after))
    q["week_confirmed"] = _on_step(lambda d: d.confirmed)
    q["confirmed_home"] = _on_step(lambda d: d.home)
    q["confirmed_elsewhere"] = _on_step(lambda d: d.elsewhere)
    q["pool_age"] = _on_step(lambda d: cf.pool_age(d.pool_after, d.day))
    q["audit_returned_home"] = _on_step(lambda d: cf.audit_returned_home(d.home, d.pool_after, d.day, d.th))
    q["audit_aged_out"] = _on_step(lambda d: cf.audit_aged_out(d.pool_after, d.day, d.th))
    q["pool_after_eviction"] = _on_step(lambda d: d.pool_evicted)
    q["streak_after_eviction"] = _on_step(lambda d: d.streak_evicted)

    q["pool_without_confirmed_home"] = _on_step(lambda d: cf.pool_without(d.pool_after, d.elsewhere, d.home))
    q["streak_without_confirmed_home"] = _on_step(lambda d: cf.streak_without(d.streak_after, d.home))

    # ---- the same operators on days on which their branches hold many rows
    q["no_reference_yet_first"] = _on_step(lambda d: rf.no_reference_yet(d.today, d.ref), FIRST_DAY)
    q["streak_new_weekend"] = _on_step(lambda d: sk.streak_new(d.mover_feed, d.streak, d.day), WEEKEND_DAY)
    q["streak_merge_weekend"] = _on_step(lambda d: d.streak_after, WEEKEND_DAY)
    q["history_update_weekend"] = _on_step(lambda d: d.history_after, WEEKEND_DAY)
    q["confirmed_home_late"] = _on_step(lambda d: d.home, LATE_DAY)
    q["audit_returned_home_late"] = _on_step(lambda d: cf.audit_returned_home(d.home, d.pool_after, d.day, d.th), LATE_DAY)
    q["pool_after_eviction_late"] = _on_step(lambda d: d.pool_evicted, LATE_DAY)
    q["streak_after_eviction_late"] = _on_step(lambda d: d.streak_evicted, LATE_DAY)

    # ---- whole run: projections of every user's state at the end
    q["mover_pool_final"] = _on_run(lambda r: r.pool)
    q["mover_streak_final"] = _on_run(lambda r: r.streak)
    q["reference_history"] = _on_run(lambda r: r.history)
    q["evictions"] = _on_run(lambda r: r.evictions)
    q["evictions_aged"] = _on_run(lambda r: r.evictions, TH_AGED)
    q["mover_pool_aged"] = _on_run(lambda r: r.pool, TH_AGED)
    q["mover_streak_aged"] = _on_run(lambda r: r.streak, TH_AGED)
    q["home_seen_in_pool"] = _on_run(lambda r: r.home_seen_in_pool)
    q["potential_movers"] = _on_run(lambda r: r.potential_movers)
    q["moves"] = _on_run(lambda r: r.moves)
    q["user_registry"] = _on_run(lambda r: r.registry)
    q["scan_state_distinct"] = _on_run(lambda r: r.history.select("user_id", "zipcode").distinct())
    q["run_metrics"] = lambda s, sf: run_metrics(_visits(s, sf), TH, tb.last_day(s, sf), unique=True)
    q["pool_profile"] = _on_run(lambda r: r.pool_profile)

    # ---- daily job: versions of changed users, merged on reading
    q["daily_state_pool"] = lambda s, sf: _daily_store(s, sf, TH).pool()
    q["daily_state_streak"] = lambda s, sf: _daily_store(s, sf, TH_AGED).streak()
    q["daily_state_evictions"] = lambda s, sf: _last_evictions(_daily_store(s, sf, TH_AGED))
    q["daily_state_registry"] = lambda s, sf: _daily_store(s, sf, TH).registry()

    # ---- streaming: event-time day buckets, per-user state across micro-batches, late sightings
    q["stream_daily_home_zip"] = lambda s, sf: ms.run_daily_home_zip_stream(s, f"{sf}/events.parquet")
    q["stream_movers"] = lambda s, sf: ms.stream_pool(ms.run_mover_stream(_dhz(s, sf), TH))
    q["stream_movers_aged"] = lambda s, sf: ms.stream_pool(ms.run_mover_stream(_dhz(s, sf), TH_AGED))
    q["stream_evictions"] = lambda s, sf: ms.stream_evictions(ms.run_mover_stream(_dhz(s, sf), TH_AGED))
    q["stream_late_corrected"] = lambda s, sf: ms.run_late_stream(_dhz(s, sf), TH, F.expr(LATE_BY), tb.last_day(s, sf))
    return q
