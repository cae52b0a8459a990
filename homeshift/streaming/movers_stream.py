"""Structured Streaming variants.

``daily_home_zip_stream`` (tumbling day buckets of raw events): a watermarked
event-time aggregation rolls events up to visits per 1-day window; a day is
emitted once the watermark closes it, and ``foreachBatch`` turns each closed
day into home zips with the same batch operator.

``mover_stream`` (per-user state carried from day to day): daily home zips
arrive as files, in any order within ``lateness``.  ``transformWithState`` keeps the states of a group of users (by hash of
the id) in typed columns of a RocksDB store.  Sightings wait in a list until an event-time timer says that the watermark has closed
their day; then they are applied in order of days by ``UserState``, learning the reference on the fly.  The timer also
fires when the pool rows of a user reach the age limit without the user being seen.  Each micro-batch writes, for every woken user, the
current pool / streak / reference rows and the eviction audits, in a folder of that batch; ``latest_state`` reads each
user's last batch.

A sighting that comes behind the watermark is written as a ``late`` row and changes nothing; ``correct_late`` replays the
users that have one from the stored days, and ``corrected_pool`` puts their rows in place of the stream's.

The state of a user is its reference, history counters, streak, pool rows and the waiting
days (at most ``lateness`` of them).  It is kept for good: the reference and the history
decide how the next sighting is routed.

Bounded input (``run_*``): a stream can't know that its input has ended, so the last day stays open.
``close_input`` adds one marker row behind the last day to a second source folder; the restarted
query then closes every day up to the last one.
"""

from __future__ import annotations

import datetime as _dt
import os
import posixpath
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from homeshift.config import Thresholds
from homeshift.operators import home_zip as hz
from homeshift.operators import user_state as us
from homeshift.operators.fold import EPOCH, FOLD_COLUMNS, UserState
from homeshift.operators.partitioning import user_partitions
from homeshift.schemas import FOLD_OUTPUT
from homeshift.session import is_file, materialize, path_exists, scratch_path, ship_package
from homeshift.sources.tables import visit_rows

DAY_MS = 86_400_000

STREAM_OUTPUT = T.StructType(FOLD_OUTPUT.fields + [T.StructField("as_of", T.DateType())])
STORED_OUTPUT = T.StructType(STREAM_OUTPUT.fields + [T.StructField("batch", T.LongType())])
USERS_A_PARTITION = 8000  # of a bounded input: a user takes some tenths of a millisecond in a micro-batch, opening and committing a store hundreds
USERS_A_GROUP = 200  # of a bounded input, on average
USER_GROUPS = 4096  # of a stream whose number of users isn't known
MARKER_USER = -1  # user id of the row that closes a bounded input
HOME_ZIPS = "user_id long, zipcode string, day date"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# ----------------------------------------------------------- home zip stream

def wall_clock_as_utc(c: F.Column, with_time: bool = True) -> F.Column:
    """Event time whose UTC instant equals a wall-clock value (NTZ timestamp, or a date).

    Built from the wall-clock fields, so no time zone is involved; day windows
    are aligned on UTC midnights, so each wall-clock day is exactly one window
    whatever the session time zone is.
    """
    secs = F.unix_date(F.to_date(c)).cast("bigint") * 86400
    if with_time:
        secs = secs + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c))
    return F.timestamp_seconds(secs)


def visits_by_window(ev: DataFrame) -> DataFrame:
    """events (with ``event_time``) -> visits per 1-day event-time window (same rules as the batch rollup).

    Day and hour come from the wall-clock ``ts``; the window from ``event_time``,
    so each wall-clock day is exactly one window.
    """
    g = visit_rows(ev, "event_time").groupBy(
        F.window("event_time", "1 day").alias("w"), "date", "cookie", "zipcode", "tranche"
    )
    return g.agg(F.sum("n").cast("bigint").alias("nb_hits")).select("cookie", "zipcode", "tranche", "date", "nb_hits")


def read_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Streaming read of a folder, or of a single file on any file system."""
    src = spark.readStream.schema(schema)
    if is_file(spark, path):  # the file source wants a folder
        return src.option("pathGlobFilter", posixpath.basename(path)).parquet(posixpath.dirname(path))
    return src.parquet(path)


def daily_home_zip_stream(spark: SparkSession, events_path: str, out_path: str, checkpoint: str,
                          lateness: str = "1 hour", closing_path: str | None = None, max_files: int | None = None):
    """Start the event-time rollup; each micro-batch writes the home zips of the days it closes.

    ``closing_path``: folder of closing markers with the events' schema (see ``close_input``).
    """
    schema = spark.read.parquet(events_path).schema
    ev = read_files(spark, events_path, schema)
    if closing_path:
        ev = ev.unionByName(spark.readStream.schema(schema).parquet(closing_path))
    # watermarks need a TIMESTAMP event time; ts stays the wall clock for day and hour
    ev = ev.withColumn("event_time", wall_clock_as_utc(F.col("ts"))).withWatermark("event_time", lateness)

    def emit(batch: DataFrame, epoch: int) -> None:
        # one folder per micro-batch, overwritten if the batch is replayed after a failure: exactly once
        hz.daily_home_zip(batch).write.mode("overwrite").parquet(f"{out_path}/batch={epoch}")

    return (visits_by_window(ev).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(emit).trigger(availableNow=True).start())


def run_daily_home_zip_stream(spark: SparkSession, events_path: str) -> DataFrame:
    """All days of a bounded input, the last one too."""
    out, ck, closing = (scratch_path(spark, n) for n in ("dhz-stream-out", "dhz-stream-ck", "dhz-stream-closing"))
    # an empty first part, so the output reads back even when no day has closed yet
    spark.createDataFrame([], "user_id long, zipcode string, day date").write.parquet(f"{out}/batch=-1")
    events = spark.read.parquet(events_path)
    events.limit(0).write.parquet(closing)
    daily_home_zip_stream(spark, events_path, out, ck, closing_path=closing).awaitTermination()
    last = events.agg(F.max("ts").alias("ts")).select(F.date_trunc("day", "ts").alias("d"))
    marker = last.select((F.col("d") + F.expr("INTERVAL 2 DAYS")).cast(events.schema["ts"].dataType).alias("ts"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema if f.name != "ts"]
    marker.select("ts", *blank).select(*events.columns).write.mode("append").parquet(closing)
    daily_home_zip_stream(spark, events_path, out, ck, closing_path=closing).awaitTermination()
    return spark.read.parquet(out).select("user_id", "zipcode", "day")


# -------------------------------------------------------------- mover stream

def _columns(rows: list[tuple], width: int) -> tuple[list, ...]:
    return tuple(map(list, zip(*rows))) if rows else tuple([] for _ in range(width))


class MoverProcessor(StatefulProcessor):
    """States of a group of users in typed columns, read and written whole, and one timer for the next thing due in the group.

    A call to the store costs about the same for one user and for hundreds, and so does a frame of rows.  So the key is a group of users,
    with a fixed number of calls a group and micro-batch.  ``users`` (value, an array a column): a user's reference, streak,
    first pool day, first / last / previous fed day.  ``pool`` and ``fed`` (values, so too): pool rows and fed history, each with its user's place in
    ``users``.  ``waiting`` (list, an entry of arrays a micro-batch): sightings of days that are still open.  ``due`` (value): the
    group's timer, at the earliest close of a waiting day or end of a pool age.
    A row behind the watermark is handed out as ``late`` and leaves the state as it is.
    """

    USERS = ("user_id array<long>, reference_zip array<string>, ref_day array<long>, streak_zip array<string>, streak_start array<long>, "
             "streak_weekend array<long>, streak_weekday array<long>, streak_week array<long>, first array<long>, fed_first array<long>, "
             "fed_last array<long>, fed_before array<long>")
    POOL = "place array<long>, zipcode array<string>, week array<long>, since array<long>"
    FED = "place array<long>, zipcode array<string>, weekend_days array<long>, weekday_days array<long>"
    WAITING = "user_id array<long>, day array<long>, zipcode array<string>"

    def __init__(self, th: Thresholds):
        self.th = th

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.users = handle.getValueState("users", self.USERS)
        self.pool = handle.getValueState("pool", self.POOL)
        self.fed = handle.getValueState("fed", self.FED)
        self.waiting = handle.getListState("waiting", self.WAITING)
        self.due = handle.getValueState("due", "at long")

    def _load(self) -> dict[int, UserState]:
        users = []
        for row in zip(*(self.users.get() or ())):
            u = UserState(row[0], row[1], row[2], self.th, learn=True)
            u.streak = None if row[3] is None else list(row[3:8])
            u.first, u.fed_days = row[8], list(row[9:12])
            users.append(u)
        for place, zipcode, week, since in zip(*(self.pool.get() or ())):
            users[place].pool[zipcode, week] = since
        for place, zipcode, we, sem in zip(*(self.fed.get() or ())):
            users[place].fed[zipcode] = [we, sem]
        return {u.user_id: u for u in users}

    def _save(self, users: list[UserState]) -> None:
        self.users.update(_columns([(u.user_id, u.ref_zip, u.ref_day, *(u.streak or (None,) * 5), u.first, *u.fed_days) for u in users], 12))
        self.pool.update(_columns([(k, z, w, since) for k, u in enumerate(users) for (z, w), since in u.pool.items()], 4))
        self.fed.update(_columns([(k, z, we, sem) for k, u in enumerate(users) for z, (we, sem) in u.fed.items()], 4))

    def _wake_at(self, due: int) -> None:
        self.handle.registerTimer(due)
        self.due.update((due,))

    def handleInputRows(self, key, rows, timerValues):
        open_day = timerValues.getCurrentWatermarkInMs() // DAY_MS  # days before it are closed
        arrived, late = [], []
        for frame in rows:
            for user, zipcode, d in zip(frame["user"].tolist(), frame["zipcode"].tolist(), frame["day"].tolist()):
                user_id = None if user is None else int(user)
                if user_id != MARKER_USER:
                    (late if d < open_day else arrived).append((user_id, int(d), zipcode))
        if arrived:
            self.waiting.appendValue(_columns(arrived, 3))
            due, old = _closes(min(d for _, d, _ in arrived)), self.due.get()
            if old is None or due < old[0]:
                if old is not None:
                    self.handle.deleteTimer(old[0])
                self._wake_at(due)
        if late:
            yield _out_rows([(u, "late") + tuple({"day": _date(d), "zipcode": z}.get(c) for c in FOLD_COLUMNS[2:]) for u, d, z in late], open_day)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        open_day = timerValues.getCurrentWatermarkInMs() // DAY_MS
        closed: dict[int, dict[int, str]] = {}  # user -> day -> zip; of a day that came twice the last row counts
        still_open = []
        for entry in self.waiting.get():
            for user_id, d, zipcode in zip(*entry):
                if d < open_day:
                    closed.setdefault(user_id, {})[d] = zipcode
                else:
                    still_open.append((user_id, d, zipcode))
        users, out = self._load(), []
        next_due = [_closes(d) for _, d, _ in still_open]
        for user_id in closed:
            if user_id not in users:
                users[user_id] = UserState(user_id, None, None, self.th, learn=True)
        for user_id, u in users.items():
            days = closed.get(user_id, {})
            for d in sorted(days):
                u.observe(d, days[d], (d + 3) % 7 >= 5)
            u.expire(open_day - 1)
            if u.first is not None:
                next_due.append(_closes(u.first + self.th.age_limit))
            if days or u.out:
                out += u.snapshot() or [(user_id, "none") + (None,) * (len(FOLD_COLUMNS) - 2)]
        if closed:
            self.waiting.clear()
            if still_open:
                self.waiting.appendValue(_columns(still_open, 3))
        if out:
            self._save(list(users.values()))
        if next_due:  # the expired timer itself is removed by Spark
            self._wake_at(min(next_due))
        else:
            self.due.clear()
        if out:
            yield _out_rows(out, open_day)


def _closes(day: int) -> int:
    """Time of the timer that fires when the watermark is past ``day``."""
    return (day + 1) * DAY_MS - 1


def _date(day: int) -> _dt.date:
    return EPOCH + _dt.timedelta(days=int(day))


def _out_rows(rows: list[tuple], open_day: int) -> pd.DataFrame:
    as_of = _date(open_day - 1) if open_day else None
    columns = dict(zip(FOLD_COLUMNS, zip(*rows)))
    return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in columns.items()} | {"as_of": pd.Series([as_of] * len(rows), dtype=object)})


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def _package_on_the_driver(spark: SparkSession):
    """The driver asks the processor for its state variables in a worker of its own, which does not get shipped files."""
    env = spark.sparkContext.environment
    old = env.get("PYTHONPATH")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env["PYTHONPATH"] = root if not old else os.pathsep.join([root, old])
    try:
        yield
    finally:
        env.pop("PYTHONPATH") if old is None else env.update(PYTHONPATH=old)


def _groups_of(spark: SparkSession, checkpoint: str, groups: int) -> int:
    """Number of user groups of a checkpoint: written at its first start, since its state is kept by group."""
    path = f"{checkpoint}/user_groups"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(groups,)], "groups long").write.mode("overwrite").parquet(path)
    return spark.read.schema("groups long").parquet(path).first()[0]


def mover_stream(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str, th: Thresholds,
                 available_now: bool = True, max_files: int | None = None, lateness_days: int = 0,
                 closing_path: str | None = None, settle: bool = True, partitions: int | None = None, groups: int = USER_GROUPS):
    """Start the per-user stateful stream over daily home zip files in ``source_dir``.

    Files may come in any order within ``lateness_days``; a day is applied once a
    row ``lateness_days`` + 1 days later was seen, or the input was closed.  Without ``settle`` days that the last
    files close are applied when the next files come, not by a micro-batch of their own.  ``partitions`` of the state are fixed by the
    first start of a checkpoint (default: the session's shuffle partitions), and so are ``groups``, by hash, in which users are kept:
    a group is held in memory and written whole when one of its users is woken.
    """
    ship_package(spark)
    groups = _groups_of(spark, checkpoint, groups)

    def source(path: str) -> DataFrame:
        src = spark.readStream.schema(HOME_ZIPS)
        return (src.option("maxFilesPerTrigger", max_files) if max_files else src).parquet(path)

    rows = source(source_dir)
    if closing_path:
        rows = rows.unionByName(source(closing_path))
    timed = rows.withColumn("event_time", wall_clock_as_utc(F.col("day"), with_time=False)).withWatermark("event_time", f"{lateness_days} days")
    # without the event time column Spark drops no late row: the processor sees them all and hands them out
    with _package_on_the_driver(spark):
        group = F.pmod(F.xxhash64("user_id"), F.lit(groups)).alias("user_group")
        # a frame's column of numbers turns to doubles where one is null, so ids travel as text
        rows = timed.select(F.col("user_id").cast("string").alias("user"), "zipcode", F.unix_date("day").cast("long").alias("day"), group)
        out = rows.groupBy("user_group").transformWithStateInPandas(
            MoverProcessor(th), STREAM_OUTPUT, outputMode="Append", timeMode="EventTime"
        )

    def store(batch: DataFrame, epoch: int) -> None:
        # one folder per micro-batch, overwritten if the batch is replayed after a failure: exactly once
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={epoch}")

    w = out.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(store)
    settings = {STATE_STORE: ROCKSDB, NO_DATA_BATCHES: str(settle).lower()}
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    with _settings(spark, settings):  # the query takes them when it starts
        return w.trigger(availableNow=True).start() if available_now else w.start()


def read_output(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.schema(STORED_OUTPUT).parquet(out_path)


def late_rows(out: DataFrame) -> DataFrame:
    """Sightings that came behind the watermark: (user_id, zipcode, day, batch)."""
    return out.where("kind = 'late'").select("user_id", "zipcode", "day", "batch")


def latest_state(out: DataFrame) -> DataFrame:
    """Rows of each user's last micro-batch (the state at the end of the stream), without audits."""
    own = out.where("kind <> 'late'")
    state = own.where(~F.col("kind").isin("returned", "aged"))
    last = own.groupBy("user_id").agg(F.max("batch").alias("batch"))
    return state.join(last, ["user_id", "batch"], "left_semi").where("kind <> 'none'")


def stream_pool(out: DataFrame) -> DataFrame:
    """Pool rows at the end of the stream."""
    return latest_state(out).where("kind = 'pool'").select("user_id", "zipcode", F.col("week").alias("confirmed_week"), "since")


def stream_evictions(out: DataFrame) -> DataFrame:
    """Evictions of the whole stream, one row each: (user_id, day, reason, presence_days)."""
    audits = out.where(F.col("kind").isin("returned", "aged"))
    return audits.select("user_id", "day", F.col("kind").alias("reason"), "presence_days").distinct()


def correct_late(out: DataFrame, day_history: DataFrame, th: Thresholds, horizon) -> DataFrame:
    """States, at the end of the day ``horizon``, of the users with a late sighting: replayed from the stored days.

    ``day_history``: every sighting that arrived, the late ones too (the stream's source folder).  Only those users'
    days are shuffled; their rows replace what the stream holds for them.
    """
    users = late_rows(out).select("user_id").distinct()
    days = day_history.select("user_id", "zipcode", "day").join(users, "user_id", "left_semi")
    return us.replay(days, horizon, th)


def corrected_pool(out: DataFrame, corrected: DataFrame) -> DataFrame:
    """Pool rows of the stream, with those of corrected users from their replay."""
    rest = stream_pool(out).join(corrected.select("user_id"), "user_id", "left_anti")
    return rest.unionByName(us.pool(corrected))


def close_input(spark: SparkSession, closing_path: str, last: _dt.date, lateness_days: int) -> None:
    """Write the marker that moves the watermark to the end of the day ``last``."""
    day = last + _dt.timedelta(days=1 + lateness_days)
    spark.createDataFrame([(MARKER_USER, None, day)], HOME_ZIPS).write.mode("append").parquet(closing_path)


class BoundedRun:
    """A bounded input fed to the stream in arrival order: a restart of the query for every ``chunk_days`` days of arrivals.

    A sighting arrives up to ``lateness_days`` days after its day, by a hash of user and day, and ``delay`` (a column of days)
    later still; so rows of neighbouring days are mixed, state crosses every micro-batch, and delayed rows are late.
    """

    def __init__(self, dhz: DataFrame, th: Thresholds, lateness_days: int = 2, chunk_days: int = 5, delay=None):
        self.spark, self.th, self.lateness = dhz.sparkSession, th, lateness_days
        self.source, self.out, self.checkpoint, self.closing = (scratch_path(self.spark, n) for n in ("stream-src", "stream-out", "stream-ck", "stream-closing"))
        wait = F.pmod(F.xxhash64("user_id", "day"), F.lit(lateness_days + 1)) + (F.lit(0) if delay is None else delay)
        chunk = F.floor((F.unix_date("day") + wait) / F.lit(chunk_days)).cast("int")
        self.staged = materialize(dhz.select("user_id", "zipcode", "day", chunk.alias("chunk")), "stream-staged", ["chunk"])
        users = self.staged.agg(F.approx_count_distinct("user_id")).first()[0]
        self.partitions = min(user_partitions(self.spark), 1 + users // USERS_A_PARTITION)
        self.groups = 1 + users // USERS_A_GROUP

    def go(self, settle: bool = False) -> None:
        mover_stream(self.spark, self.source, self.out, self.checkpoint, self.th, lateness_days=self.lateness, closing_path=self.closing, settle=settle, partitions=self.partitions, groups=self.groups).awaitTermination()

    def run(self) -> DataFrame:
        self.spark.createDataFrame([], HOME_ZIPS).write.parquet(self.closing)
        self.spark.createDataFrame([], STREAM_OUTPUT).write.parquet(f"{self.out}/batch=-1")
        ends = self.staged.agg(F.min("chunk"), F.max("chunk"), F.max("day")).first()
        for k in range(ends[0], ends[1] + 1) if ends[0] is not None else ():  # chunks are spans of days: bounded by the run
            self.staged.where(F.col("chunk") == k).select("user_id", "zipcode", "day").write.mode("append").parquet(self.source)
            self.go()
        if ends[2] is not None:
            close_input(self.spark, self.closing, ends[2], self.lateness)
            self.go(settle=True)
        return read_output(self.spark, self.out)

    def day_history(self) -> DataFrame:
        return self.spark.read.schema(HOME_ZIPS).parquet(self.source)


def run_mover_stream(dhz: DataFrame, th: Thresholds, lateness_days: int = 2, chunk_days: int = 5) -> DataFrame:
    """Output of the stream over a bounded input whose rows arrive within the lateness."""
    return BoundedRun(dhz, th, lateness_days, chunk_days).run()


def run_late_stream(dhz: DataFrame, th: Thresholds, delay, horizon, lateness_days: int = 2) -> DataFrame:
    """Pool at the end of a stream some of whose rows come ``delay`` days late, after the correction job."""
    run = BoundedRun(dhz, th, lateness_days, delay=delay)
    out = run.run()
    corrected = materialize(correct_late(out, run.day_history(), th, horizon), "stream-corrected")
    return corrected_pool(out, corrected)
