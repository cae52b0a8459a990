"""Batch plan of the whole detection over every day of the input.

visits -> daily home zip (partial aggregates) -> one hash exchange on user_id -> every user's days through the
state machine (``operators.user_state``) -> one row a user, written once as a parquet table in the shared
``spark.checkpoint.dir`` folder.  Every final table (reference, history, registry, pool, streak, audits, potential
movers, moves) is a projection of that table: no further exchange, no join, no Python.  Writing
it also cuts the lineage, so a lost executor does not replay the whole chain.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from homeshift.config import Thresholds
from homeshift.session import materialize
from homeshift.operators import home_zip as hz
from homeshift.operators import user_state as us


class MoverRun:
    """Whole-run tables.

    ``horizon`` is the last day of the run: a date, a Column (e.g. a scalar
    subquery over one pruned date column of the raw input), or None for the
    last day of ``dhz`` (a scalar subquery that recomputes the daily home zip).
    """

    def __init__(self, dhz: DataFrame, th: Thresholds, horizon=None, materialize: bool = True):
        self._dhz, self.th, self.materialize = dhz, th, materialize
        self._horizon = horizon

    @cached_property
    def dhz(self) -> DataFrame:
        """Home zips up to the horizon: a run never sees a later day."""
        return self._dhz if self._horizon is None else self._dhz.where(F.col("day") <= self.horizon)

    @cached_property
    def horizon(self):
        if self._horizon is None:
            return self._dhz.select(F.max("day")).scalar()
        if isinstance(self._horizon, _dt.date):
            return F.lit(self._horizon)
        return self._horizon

    @cached_property
    def states(self) -> DataFrame:
        """State of every user at the end of the run, written once."""
        out = us.replay(self.dhz, self.horizon, self.th)
        return materialize(out, "states") if self.materialize else out

    @cached_property
    def reference(self) -> DataFrame:
        return us.reference(self.states)

    @cached_property
    def pool(self) -> DataFrame:
        return us.pool(self.states)

    @cached_property
    def streak(self) -> DataFrame:
        return us.streak(self.states)

    @cached_property
    def history(self) -> DataFrame:
        """Reference history at the end of the run."""
        return us.history(self.states)

    @cached_property
    def registry(self) -> DataFrame:
        """User registry at the end of the run (first / last feed day, gap and tenure on the horizon)."""
        return us.registry(self.states, F.col("horizon"))

    @cached_property
    def evictions(self) -> DataFrame:
        """One row per eviction: (user_id, day, reason, presence_days)."""
        once = F.array_distinct(F.transform("audits", lambda a: F.struct(a["day"].alias("day"), a["kind"].alias("reason"), a["presence_days"].alias("presence_days"))))
        return self.states.select("user_id", F.inline(once))

    @cached_property
    def returned(self) -> DataFrame:
        """Audit of users evicted after a confirmed return home."""
        return us.audits(self.states).where("kind = 'returned'").select("user_id", "week", "date_min", "date_max", "day", "presence_days")

    @cached_property
    def aged(self) -> DataFrame:
        """Audit of the pool rows of users evicted for their age."""
        return us.audits(self.states).where("kind = 'aged'").select("user_id", "zipcode", F.col("week").alias("confirmed_week"), "since", "date_min", "date_max", "day", "presence_days")

    @cached_property
    def pool_users(self) -> DataFrame:
        """States of the users in the pool, with whether any of their pool rows is at their reference zip."""
        seen = F.exists("pool", lambda p: p["zipcode"] == F.col("reference_zip"))
        return self.states.where("size(pool) > 0").withColumn("home_seen", F.coalesce(seen, F.lit(False)))

    @cached_property
    def home_seen_in_pool(self) -> DataFrame:
        return self.pool_users.where("home_seen").select("user_id")

    @cached_property
    def potential_movers(self) -> DataFrame:
        return us.pool(self.pool_users.where("not home_seen"))

    @cached_property
    def moves(self) -> DataFrame:
        """Old zip (reference), new zip (latest confirmed week, then later date, then larger zip), date."""
        confirmed = F.filter("pool", lambda p: p["week"] >= 1)
        best = F.array_max(F.transform(confirmed, lambda p: F.struct(p["week"].alias("week"), p["since"].alias("since"), p["zipcode"].alias("zipcode"))))
        x = self.pool_users.where("not home_seen and reference_zip is not null").withColumn("best", best).where("best is not null")
        first = F.array_min(F.transform(F.filter("pool", lambda p: p["zipcode"] == F.col("best.zipcode")), lambda p: p["since"]))
        return x.select("user_id", F.col("reference_zip").alias("old_zip"), F.col("best.zipcode").alias("new_zip"), first.alias("moved_on"))

    @cached_property
    def pool_profile(self) -> DataFrame:
        """Per pool user: distinct states, distinct dates, confirmed zips."""
        distinct = lambda f: F.size(F.array_distinct(F.transform("pool", f))).cast("bigint")
        return self.states.where("size(pool) > 0").select(
            "user_id", distinct(lambda p: p["week"]).alias("n_states"), distinct(lambda p: p["since"]).alias("n_dates"),
            F.size(F.filter("pool", lambda p: (p["week"] >= 1) & p["zipcode"].isNotNull())).cast("bigint").alias("n_confirmed_zips"),
        )

    def counts(self) -> DataFrame:
        """One row: the row counts of every table of the run, by one aggregate over the states."""
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
        home = F.coalesce(F.exists("pool", lambda p: p["zipcode"] == F.col("reference_zip")), F.lit(False))
        mover = (F.size("pool") > 0) & ~home
        moved = mover & F.col("reference_zip").isNotNull() & F.exists("pool", lambda p: p["week"] >= 1)
        return self.states.agg(
            total("n_days").alias("daily_home_zip_rows"),
            F.count("ref_day").alias("users_with_reference"), total(F.size("fed")).alias("reference_history_rows"), F.count("streak").alias("mover_streak_rows"),
            total(F.size("pool")).alias("mover_pool_rows"), total(F.size(F.filter("audits", lambda a: a["kind"] == "returned"))).alias("returned_home_evictions"),
            F.count(F.when(mover, 1)).alias("potential_mover_users"), total(F.when(mover, F.size("pool"))).alias("potential_mover_rows"),
            F.count(F.when(moved, 1)).alias("moves_rows"),
        )


def run_metrics(visits: DataFrame, th: Thresholds, horizon, unique: bool = False) -> DataFrame:
    """Row counts of the input and of every table of a run, as (metric, value) rows.

    The input is counted by ``observe`` while the states are written, so it is read once.  An observed count includes
    the rows of a map stage that had to run again after a lost executor; the other counts come from the written table.
    """
    seen = Observation("homeshift-input")
    counted = visits.observe(seen, F.count(F.lit(1)).alias("visits_rows"))
    counts = MoverRun(hz.daily_home_zip(counted, unique=unique), th, horizon).counts()
    counts = counts.select(F.lit(seen.get["visits_rows"]).cast("bigint").alias("visits_rows"), "*")
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in counts.columns])))
