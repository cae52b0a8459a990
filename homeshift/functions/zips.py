"""Zipcode and time-of-day predicates as built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A valid zipcode has 5 characters; time-of-day codes 2 and 3
# are the home hours; labels of the two classes of hours.
ZIP_LENGTH = 5
HOME_TRANCHES = (2, 3)
HOME_LABEL = "home"
OTHER_HOURS_LABEL = "middayOrWork"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_valid_zip(z) -> Column:
    return F.length(_c(z)) == ZIP_LENGTH


def is_home_hours(tranche) -> Column:
    return _c(tranche).isin(*HOME_TRANCHES)


def home_hours_label(tranche) -> Column:
    """'home' for tranche 2 or 3, else 'middayOrWork' (null tranche included)."""
    return F.when(is_home_hours(tranche), F.lit(HOME_LABEL)).otherwise(F.lit(OTHER_HOURS_LABEL))


def zip_equal_flag(a, b) -> Column:
    """1 when equal, null equal to null, else 0 (replaces the Python UDF)."""
    return F.when(_c(a).eqNullSafe(_c(b)), F.lit(1)).otherwise(F.lit(0))


def safe_share(part, total) -> Column:
    """part / total, and 0.0 when the total is 0 (also safe under ANSI mode)."""
    total = _c(total)
    return F.when(total == 0, F.lit(0.0)).otherwise(_c(part) / (total * F.lit(1.0)))
