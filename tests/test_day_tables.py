"""Day tables: a commit a day, broken jobs, days from names, folders of differing columns, pruning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from homeshift import schemas
from homeshift.session import scratch_path
from homeshift.sources import calendar as cal
from homeshift.sources import small_files as sf
from homeshift.sources import tables as tb
from homeshift.sources.day_tables import DayTables
from places import SF_SMALL


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_broken_day_is_written_again_and_finished_days_are_not_touched(spark, monkeypatch):
    v = tb.visits(spark, SF_SMALL).persist()
    store = DayTables(spark, scratch_path(spark, "days"))
    store.add_days(v.where("date < DATE'2024-01-05'"))
    good = store.day_list()
    stamp = [f.getModificationTime() for f in sf._fs(spark, store.folder(good[0]))[0].listStatus(sf._fs(spark, store.folder(good[0]))[1])]

    # a job that breaks off while the third of its days is committed: moved into place, no marker
    calls, real = [], sf.write_once

    def breaks(spark, path, text):
        calls.append(path)
        if len(calls) == 3:
            raise RuntimeError("lost")
        real(spark, path, text)

    monkeypatch.setattr(sf, "write_once", breaks)
    with pytest.raises(RuntimeError):
        store.add_days(v.withColumn("nb_hits", F.lit(-1).cast("long")))
    monkeypatch.setattr(sf, "write_once", real)
    assert len(store.day_list()) == len(good) + 2
    half = sorted(set(r[0] for r in v.select("date").distinct().collect()) - set(store.day_list()))[0]
    assert f"date={half.isoformat()}" in sf.list_names(spark, store.path) and not store.exists(half)
    assert store.read(v.schema).where(F.col("date") == F.lit(half)).count() == 0  # half-written: not read

    added = store.add_days(v)
    assert half in added and not set(added) & set(good)
    got = store.read(v.schema).where(F.col("date").isin(added) | F.col("date").isin(good))
    assert rows(got) == rows(v.where(F.col("date").isin(added) | F.col("date").isin(good)))
    assert stamp == [f.getModificationTime() for f in sf._fs(spark, store.folder(good[0]))[0].listStatus(sf._fs(spark, store.folder(good[0]))[1])]
    assert store.add_days(v) == []
    v.unpersist()


def test_finished_days_are_filtered_before_they_are_read(spark):
    v = tb.visits(spark, SF_SMALL)
    src = scratch_path(spark, "src")
    v.write.partitionBy("date").parquet(src)
    store = DayTables(spark, scratch_path(spark, "days"))
    whole = spark.read.schema(v.schema).parquet(src).select(*v.columns)
    store.add_days(whole.where("date < DATE'2024-01-20'"))
    rest = whole.where(~F.col("date").isin(store.day_list()))
    assert "PartitionFilters: [" in plan(rest) and "date" in plan(rest).split("PartitionFilters: [")[1].split("]")[0]
    assert len(store.add_days(whole)) == 11 and store.read(v.schema).count() == v.count()


def test_a_large_day_is_split_and_small_days_share_tasks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        big, small = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
        rows_ = spark.range(0, 100_000, 1, 4).select(F.col("id").cast("string").alias("cookie"), F.when(F.col("id") < 99_000, F.lit(big)).otherwise(F.date_add(F.lit(small), (F.col("id") % 20).cast("int"))).alias("date"))
        store = DayTables(spark, scratch_path(spark, "days"))
        store.add_days(rows_)
        files = {d: len([n for n in sf.list_names(spark, store.folder(d)) if n.endswith(".parquet")]) for d in store.day_list()}
        assert len(files) == 21 and files[big] > 3 and max(n for d, n in files.items() if d != big) <= 2
        assert store.read(rows_.schema).count() == 100_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_days_come_from_names(spark):
    """The data files are gone; the days are still known."""
    v = tb.visits(spark, SF_SMALL)
    store = DayTables(spark, scratch_path(spark, "days"))
    store.add_days(v)
    for d in store.day_list():
        for n in sf.list_names(spark, store.folder(d)):
            sf.delete(spark, f"{store.folder(d)}/{n}")
    days = store.days()
    assert cal.available_days(days).count() == 28 and cal.missing_days(days).count() == 19
    assert [r["exists"] for r in cal.day_exists(days).orderBy("day").collect()] == [False] * 2 + [True] * 30 + [False] * 2
    assert store.exists(dt.date(2024, 1, 3)) and not store.exists(dt.date(2023, 1, 3))
    for df in (cal.available_days(days), cal.missing_days(days), cal.day_exists(days)):
        assert "FileScan" not in plan(df)


def test_folders_of_differing_order_and_types(spark):
    store = DayTables(spark, scratch_path(spark, "days"))
    a, b, c, d = (dt.date(2024, 1, i) for i in (1, 2, 3, 4))
    store.add_days(spark.createDataFrame([("1", "75001", 2, a, 5)], schemas.VISITS))
    for sql, day in (
        ("SELECT 7 AS nb_hits, '75002' AS zipcode, '3' AS tranche, 2L AS cookie", b),  # another order, other types
        ("SELECT 'x' AS tranche, 9L AS nb_hits, 75003 AS zipcode, '3' AS cookie", c),  # a value that can't be cast
        ("SELECT '4' AS cookie, '75004' AS zipcode, 1L AS nb_hits", d),  # a column missing
    ):
        store.add_days(spark.sql(sql).withColumn("date", F.lit(day)))
    got = sorted(map(tuple, store.read_days(schemas.VISITS).collect()))
    assert got == [
        ("1", "75001", 2, a, 5, "20240101"), ("2", "75002", 3, b, 7, "20240102"), ("3", "75003", None, c, 9, "20240103"), ("4", "75004", None, d, 1, "20240104"),
    ]
    assert [r["cookie"] for r in store.read_days(schemas.VISITS, [b]).collect()] == ["2"]


def test_equal_folders_are_one_scan(spark):
    v = tb.visits(spark, SF_SMALL)
    store = DayTables(spark, scratch_path(spark, "days"))
    store.add_days(v)
    df = store.read_days(schemas.VISITS)
    assert plan(df).count("FileScan") == 1 and df.count() == v.count() and df.columns == [*schemas.VISITS.fieldNames(), "day1"]


def test_folders_are_pruned_by_a_table_of_days(spark):
    v = tb.visits(spark, SF_SMALL)
    store = DayTables(spark, scratch_path(spark, "days"))
    store.add_days(v)
    wanted = store.days().where("dayofweek(day) IN (1, 7)")
    df = store.read_where(schemas.VISITS, wanted)
    assert rows(df) == rows(v.select(*schemas.VISITS.fieldNames()).where("dayofweek(date) IN (1, 7)"))
    assert "dynamicpruning" in plan(df)
    df.collect()
    one = store.read(schemas.VISITS, [dt.date(2024, 1, 7)])
    assert rows(one) == rows(v.select(*schemas.VISITS.fieldNames()).where("date = DATE'2024-01-07'"))
    assert "InMemoryFileIndex(1 paths)" in plan(one)


def test_no_days(spark):
    store = DayTables(spark, scratch_path(spark, "days"))
    assert store.day_list() == [] and store.read(schemas.VISITS).count() == 0 and store.read_days(schemas.VISITS).count() == 0
    assert cal.available_days(store.days()).count() == 0
