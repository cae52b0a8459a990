"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare
from places import SF_SMALL, SF_MID

KEYS = sorted(k for k in E.queries() if not k.startswith("op") and k != "pipeline")
WITH_ORACLE = set(E.oracle_sql())


def test_every_query_has_an_oracle():
    missing = [k for k in KEYS if k not in WITH_ORACLE and not k.startswith("op") and k != "pipeline"]
    assert missing == []


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle_small(spark, key):
    res = compare(spark, SF_SMALL, [key], verbose=False)[key]
    if res[0] == "rows-only":
        return
    assert all(res), res


@pytest.mark.parametrize("key", ["daily_home_zip", "reference_zip", "mover_pool_final", "moves", "route_day"])
def test_matches_oracle_mid(spark, key):
    assert all(compare(spark, SF_MID, [key], verbose=False)[key])
