"""State tables at the end of the day before ``day``, and that day's steps.

The state is that of the days before ``day`` when nobody is ever evicted; the one-day operators then run on it exactly as
the reference runs one day of its loop.  Used to check every branch of the daily step on real data.

One pass over the home zips gives every user's state (``operators.user_state``) and today's zip.  It is written once, as a
table bucketed by user: the state tables are projections of it, and joins between them need no exchange.  The merged
streak / pool rows, which several later steps read, are written as a parquet table in the shared
checkpoint folder the first time they are used, so a lost executor only replays from there.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeshift.config import Thresholds
from homeshift.session import materialize
from homeshift.operators import confirm as cf
from homeshift.operators import reference as rf
from homeshift.operators import streak as sk
from homeshift.operators import user_state as us
from homeshift.operators.partitioning import by_user_partitions
from homeshift.sources import catalog_tables as ct

#: Limits under which nobody is evicted.
NEVER = {"return_limit": -1, "age_limit": 1_000_000}


class DayStep:
    def __init__(self, dhz: DataFrame, day: _dt.date, th: Thresholds, materialize: bool = True):
        self._dhz, self.day, self.th, self.materialize = dhz, day, th, materialize

    # ------------------------------------------------------------ state before
    @cached_property
    def base(self) -> DataFrame:
        """Every user's state before the day, and its home zip of the day; written once, bucketed by user."""
        d = F.lit(self.day)
        th = self.th.with_(**NEVER)
        before = F.sort_array(F.collect_list(F.when(F.col("day") < d, F.struct("day", "zipcode"))))
        users = by_user_partitions(self._dhz.where(F.col("day") <= d)).groupBy("user_id").agg(  # later days are never read
            before.alias("days"), F.max(F.when(F.col("day") == d, F.col("zipcode"))).alias("today")
        )
        end = F.aggregate("days", us.empty_state(), lambda s, x: us.step(s, x["day"], x["zipcode"], th))
        out = users.select("user_id", "today", end.alias("s")).select("user_id", "today", "s.*")
        return ct.save_table(out, ct.fresh_name("daystep")) if self.materialize else out

    @cached_property
    def ref(self) -> DataFrame:
        return us.reference(self.base).select("user_id", "reference_zip")

    @cached_property
    def history(self) -> DataFrame:
        return us.history(self.base)

    @cached_property
    def registry(self) -> DataFrame:
        return us.registry(self.base, F.lit(self.day - _dt.timedelta(days=1)))

    @cached_property
    def streak(self) -> DataFrame:
        return us.streak(self.base)

    @cached_property
    def pool(self) -> DataFrame:
        return us.pool(self.base)

    # --------------------------------------------------------------- the day
    @cached_property
    def today(self) -> DataFrame:
        return self.base.where("today is not null").select("user_id", F.col("today").alias("zipcode"))

    @cached_property
    def compared(self) -> DataFrame:
        return rf.compare_with_reference(self.today, self.ref)

    @cached_property
    def routed_today(self) -> DataFrame:
        """Today's users with their route: reference (no reference yet), home or mover."""
        no_ref = rf.no_reference_yet(self.today, self.ref).select(
            "user_id", "zipcode", F.lit(rf.ROUTE_REFERENCE).alias("route"))
        routed = rf.route_day(self.compared, self.pool).select("user_id", "zipcode", "route")
        return no_ref.unionByName(routed)

    @cached_property
    def feeds(self) -> tuple[DataFrame, DataFrame]:
        r = self.routed_today
        ref_feed = r.where(F.col("route") != rf.ROUTE_MOVER).select("user_id", "zipcode")
        mover_feed = r.where(F.col("route") == rf.ROUTE_MOVER).select("user_id", "zipcode").distinct()
        return ref_feed, mover_feed

    @property
    def reference_feed(self) -> DataFrame:
        return self.feeds[0]

    @property
    def mover_feed(self) -> DataFrame:
        return self.feeds[1]

    @cached_property
    def history_after(self) -> DataFrame:
        return rf.history_update(self.history, self.reference_feed, self.day)

    @cached_property
    def registry_after(self) -> DataFrame:
        return rf.registry_update(self.registry, self.reference_feed, self.day)

    @cached_property
    def passed(self) -> DataFrame:
        """Streak and pool rows at the end of the day, tagged; written once, read by kind."""
        out = sk.day_state(self.mover_feed, self.streak, self.pool, self.day)
        return materialize(out, "daystep", ["kind"]) if self.materialize else out

    @cached_property
    def streak_after(self) -> DataFrame:
        return self.passed.where("kind = 'streak'").select(*sk.STREAK_COLS)

    @cached_property
    def pool_after(self) -> DataFrame:
        return self.passed.where("kind = 'pool'").select(*sk.POOL_COLS)

    @cached_property
    def confirmed(self) -> DataFrame:
        return cf.week_confirmed(self.streak_after, self.day, self.th)

    @cached_property
    def home(self) -> DataFrame:
        return cf.confirmed_home(self.confirmed, self.ref)

    @cached_property
    def elsewhere(self) -> DataFrame:
        return cf.confirmed_elsewhere(self.confirmed, self.ref, self.day)

    @cached_property
    def ended(self) -> DataFrame:
        """Streak and pool rows after the day's confirmation and eviction, tagged."""
        return cf.end_of_day(self.passed, self.ref, self.day, self.th)

    @cached_property
    def pool_evicted(self) -> DataFrame:
        return cf.pool_at_end(self.ended)

    @cached_property
    def streak_evicted(self) -> DataFrame:
        return cf.streak_at_end(self.ended)
