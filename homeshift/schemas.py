"""Schemas of the inputs and of every state table (counters fixed to bigint)."""

from __future__ import annotations

from pyspark.sql import types as T

L, S, I, D = T.LongType(), T.StringType(), T.IntegerType(), T.DateType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


VISITS = _st(("cookie", S), ("zipcode", S), ("tranche", I), ("date", D), ("nb_hits", L))
DAILY_HOME_ZIP = _st(("user_id", L), ("zipcode", S), ("day", D))

COMPARED_TODAY = _st(("user_id", L), ("zipcode", S), ("matches_reference", I))
REFERENCE_FEED = _st(("user_id", L), ("zipcode", S))
MOVER_FEED = _st(("user_id", L), ("zipcode", S))
REFERENCE_HISTORY = _st(("user_id", L), ("zipcode", S), ("weekend_days", L), ("weekday_days", L))
USER_REGISTRY = _st(
    ("user_id", L), ("last_seen", D), ("first_seen", D), ("gap_days", I), ("tenure_days", I)
)
REFERENCE_ZIP = _st(("user_id", L), ("reference_zip", S))
MOVER_STREAK = _st(
    ("user_id", L), ("zipcode", S), ("streak_start", D),
    ("weekend_days", L), ("weekday_days", L), ("week_no", I),
)
MOVER_POOL = _st(("user_id", L), ("zipcode", S), ("confirmed_week", I), ("since", D))
MOVES = _st(("user_id", L), ("old_zip", S), ("new_zip", S), ("moved_on", D))

# Output of the per-user step in Python (the stream): one small record stream, told apart by ``kind``.
#   reference  the user's reference zip and the day it was fixed
#   history    reference history row (days fed per zip, weekend / weekday)
#   registry   first / last day fed, gap and tenure on the horizon day
#   pool       final pool rows of live users
#   streak     final streak row of live users
#   returned   audit row of a user evicted after a confirmed return home
#   aged       audit rows (one per pool row) of a user evicted for pool age
FOLD_OUTPUT = _st(
    ("user_id", L), ("kind", S), ("day", D), ("zipcode", S),
    ("week", I), ("since", D), ("streak_start", D),
    ("weekend_days", L), ("weekday_days", L),
    ("date_min", D), ("date_max", D), ("presence_days", I),
    ("first_seen", D), ("last_seen", D), ("gap_days", I), ("tenure_days", I),
)

STATE_TABLES = {
    "compared_today": COMPARED_TODAY,
    "reference_feed": REFERENCE_FEED,
    "mover_feed": MOVER_FEED,
    "reference_history": REFERENCE_HISTORY,
    "user_registry": USER_REGISTRY,
    "reference_zip": REFERENCE_ZIP,
    "mover_streak": MOVER_STREAK,
    "mover_pool": MOVER_POOL,
    "moves": MOVES,
}


def empty(spark, name: str):
    """Typed empty state table (the reference's CREATE TABLE IF NOT EXISTS)."""
    return spark.createDataFrame([], STATE_TABLES[name])
