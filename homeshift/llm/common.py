"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homeshift.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def gapless_rank(df: DataFrame, group: list[str], order: list[str], out: str, buckets: int) -> DataFrame:
    """``out``: position from 0 of each row within ``group``, gapless, without sorting a group in one task.

    Rows are dealt by a hash of ``order`` into ``buckets`` parts of each group; a
    window numbers each part, and the parts' counts (groups x buckets rows)
    give the offset of every part.  The order over a whole group is by
    (part, order); ``order`` must identify a row, else ties are numbered in any order.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    df = df.withColumn("_part", part)
    counts = df.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order)) - 1
    return (
        df.withColumn("_local", local)
        .join(offsets, [*group, "_part"])
        .withColumn(out, (F.col("_offset") + F.col("_local")).cast("long"))
        .drop("_part", "_offset", "_local")
    )


def place_by_rank(df: DataFrame, key: str, rank: str, spans: list[tuple], outs: list[str]) -> DataFrame:
    """Adds the columns ``outs`` (long) of the span (key, lo, hi, *outs) with ``lo <= rank < hi`` to each row.

    The spans of a key follow each other from 0 without a gap and cover all its ranks.  They go to every task as sorted
    arrays (8 bytes a number; the callers bound their number) and are found by binary search, so a key that holds most
    rows is not a join key.
    """
    keys = np.array(sorted({s[0] for s in spans}), dtype=np.int64)
    width = max((int(s[2]) for s in spans), default=0) + 1
    if len(keys) * width >= 1 << 62:
        raise OverflowError("too many keys and ranks for one sorted array")
    begin = np.array([np.searchsorted(keys, s[0]) * width + s[1] for s in spans], dtype=np.int64)
    order = np.argsort(begin, kind="stable")
    table = [begin[order], *(np.array([s[3 + i] for s in spans], dtype=np.int64)[order] for i in range(len(outs)))]
    shared = df.sparkSession.sparkContext.broadcast((keys, table))
    at, of = df.columns.index(key), df.columns.index(rank)

    def run(batches):
        keys, (begin, *values) = shared.value
        for b in batches:
            own = np.searchsorted(keys, b.column(at).to_numpy(zero_copy_only=False)) * width + b.column(of).to_numpy(zero_copy_only=False)
            hit = np.searchsorted(begin, own, side="right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(v[hit]) for v in values)], [*b.schema.names, *outs])

    have = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, have + "".join(f", {c} long" for c in outs))
