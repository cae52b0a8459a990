"""homeshift: home-location and mover detection as Spark DataFrame jobs.

Visits counted per user, zipcode, day and time of day become one home zipcode
per user and day, a long-term reference zipcode per user, runs of days spent
at another zipcode, weekly confirmations, evictions and finally the list of
potential movers.  Everything is keyed by ``user_id``; the plans keep a single
hash partitioning on that key from the per-user windows to the per-user fold.
"""

from homeshift.config import Thresholds, FIXTURE_THRESHOLDS, SNAPSHOT_DAY

__all__ = ["Thresholds", "FIXTURE_THRESHOLDS", "SNAPSHOT_DAY"]
