"""Catalog tables: appended by position and by name, bucketed joins, attached again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from homeshift.session import scratch_path
from homeshift.sources import catalog_tables as ct


def rows(df):
    return sorted(map(tuple, df.collect()))


def base(spark):
    return spark.createDataFrame([(1, "75001", dt.date(2024, 1, 1)), (2, "75002", dt.date(2024, 1, 2))], "user_id long, zipcode string, day date")


def test_by_position_ignores_names_and_by_name_ignores_order(spark):
    name = ct.fresh_name("t")
    ct.save_table(base(spark), name)
    more = spark.createDataFrame([(3, "75003", dt.date(2024, 1, 3))], "zipcode long, day string, user_id date")  # names of other columns
    ct.insert_by_position(more, name)
    swapped = spark.createDataFrame([(dt.date(2024, 1, 4), 4, "75004")], "day date, user_id long, zipcode string")
    ct.append_by_name(swapped, name)
    assert rows(spark.table(name)) == [(i, f"7500{i}", dt.date(2024, 1, i)) for i in (1, 2, 3, 4)]
    with pytest.raises(ValueError, match="columns"):
        ct.insert_by_position(base(spark).select("user_id", "zipcode"), name)
    with pytest.raises(Exception):  # a text for a number is refused, not made null
        ct.insert_by_position(swapped.select("zipcode", "zipcode", "day"), name)
        spark.table(name).collect()
    assert spark.table(name).count() == 4
    with pytest.raises(Exception):
        ct.save_table(base(spark), name)  # a table is never overwritten


def test_bucketed_tables_join_and_group_without_an_exchange(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    big = spark.range(1000).select(F.col("id").alias("user_id"), (F.col("id") * 2).alias("x"))
    a, b = (ct.save_table(big, ct.fresh_name(k)) for k in "ab")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = a.join(b.withColumnRenamed("x", "y"), "user_id").groupBy("user_id").agg(F.sum("y").alias("y"))
        p = j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in p and f"SelectedBucketsCount: {n} out of {n}" in p and j.count() == 1000


def test_attach_and_partitions(spark):
    name, path = ct.fresh_name("t"), scratch_path(spark, "attached")
    ct.save_table(base(spark).withColumn("version", F.lit("a")), name, path, 3, partition_by=["version"])
    ct.save_table(base(spark).withColumn("version", F.lit("b")), name, path, 3, partition_by=["version"], mode="append")
    assert rows(ct.partitions_of(spark, name)) == [("version=a",), ("version=b",)]
    want = rows(spark.table(name))
    ct.drop_table(spark, name)
    again = ct.attach(spark, name, path, "user_id bigint, zipcode string, day date, version string", 3, partition_by=["version"])
    assert rows(again) == want and len(want) == 4
    p = again.groupBy("user_id").agg(F.max("version"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p  # a bucket is read from every partition by one task


def test_empty_table(spark):
    name = ct.fresh_name("t")
    ct.save_table(base(spark).where("false"), name)
    assert ct.insert_by_position(base(spark), name).count() == 2
