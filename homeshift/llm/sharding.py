"""Operator 7: shards of near-equal bytes, by longest-processing-time scheduling of groups that stay together.

Rows with equal text form a group; a group goes to one shard.  Groups are taken by
size, largest first, each to the least-loaded shard (a heap over shard loads).

At scale the list of all groups never reaches the driver.  Only its size
profile does: the groups that hold more than 1 / ``SINGLE`` of all bytes or rows (at most
2 x ``SINGLE`` of them) one by one, and the others as (size class, number of groups).  A class
is a size cut to 16 significant bits, exact below 65,536 bytes, so there are at
most 32,768 classes per doubling of the size.  The heap deals a class out in bulk, and the
groups of a class are numbered without gaps by a distributed rank that is matched with
the heap's intervals.

Skew: groups that are hot in bytes or rows are joined by broadcast (a bounded list);
all others are small by definition.

Defined results: null text has no bytes and size 1 and is grouped with empty texts; null ids and repeated rows are rows like others;
very long texts are one row each; groups of equal size are dealt in order of their digests; other columns of the input, whatever their
names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeshift.llm.common import gapless_rank, place_by_rank, shuffle_partitions
from homeshift.session import materialize

SINGLE = 4096


def _deal(loads: list, n: int, size: float) -> list[tuple[int, int]]:
    """Deal ``n`` items of one size out by the heap ``loads`` ((load, shard) pairs): (shard, items)."""
    given: dict[int, int] = {}
    if n > 8 * len(loads):  # what the heap gives until all are level, in one step
        level = sorted(loads)
        k, fill = 0, 0.0
        for k in range(1, len(level) + 1):
            fill = (sum(x for x, _ in level[:k]) + n * size) / k
            if k == len(level) or fill <= level[k][0]:
                break
        for load, shard in level[:k]:
            given[shard] = min(max(0, int((fill - load) / size) - 2), n - sum(given.values()))
        loads[:] = [(load + given.get(shard, 0) * size, shard) for load, shard in loads]
        heapq.heapify(loads)
    for _ in range(n - sum(given.values())):
        load, shard = loads[0]
        given[shard] = given.get(shard, 0) + 1
        heapq.heapreplace(loads, (load + size, shard))
    return sorted(x for x in given.items() if x[1])


def schedule(singles: list[tuple[object, int]], classes: list[tuple[int, int, int]], shards: int):
    """LPT over single groups (key, bytes) and classes (class, groups, bytes).

    Returns ({key: shard}, [(class, first rank, end rank, shard)], loads).
    """
    todo = [(size, 1, key, None) for key, size in singles] + [(total / n, n, None, cls) for cls, n, total in classes]
    todo.sort(key=lambda x: (-x[0], x[3] is not None, str(x[2]), x[3] or 0))
    loads = [(0.0, s) for s in range(shards)]
    own, spans = {}, []
    for size, n, key, cls in todo:
        at = 0
        for shard, count in _deal(loads, n, size):
            if cls is None:
                own[key] = shard
            else:
                spans.append((cls, at, at + count, shard))
                at += count
    return own, spans, [x for x, _ in sorted(loads, key=lambda x: x[1])]


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; equal texts share a shard, shards have near-equal bytes."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), raw.alias("b")).select(
        "id",
        F.unhex(F.sha2("b", 256)).alias("grp"),
        (F.octet_length("b") + 1).cast("long").alias("size"),
        F.crc32("b").alias("text_crc32"),
    )
    rows = materialize(rows, "shard-rows")
    groups = materialize(rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    large = (F.col("bytes") * SINGLE > total["b"]) | (F.col("n") * SINGLE > total["n"])
    shift = F.greatest(F.length(F.bin("bytes")) - 16, F.lit(0))
    small = groups.where(~large).withColumn("cls", F.call_function("shiftleft", F.call_function("shiftright", F.col("bytes"), shift), shift))
    singles = [(bytes(r["grp"]), r["bytes"]) for r in groups.where(large).select("grp", "bytes").collect()]  # at most 2 x SINGLE
    profile = [tuple(r) for r in small.groupBy("cls").agg(F.count(F.lit(1)), F.sum("bytes")).collect()]  # size classes
    own, spans, _ = schedule(singles, profile, shards)

    own_df = spark.createDataFrame([(bytearray(k), v) for k, v in own.items()], "grp binary, own int")
    ranked = gapless_rank(small.select("grp", "cls"), ["cls"], ["grp"], "rank", parts)
    placed = place_by_rank(ranked, "cls", "rank", spans, ["shard"]).select("grp", F.col("shard").cast("int").alias("shard"))
    hot = rows.join(F.broadcast(own_df), "grp", "left")
    one = hot.where("own is not null").select("id", "size", "text_crc32", F.col("own").alias("shard"))
    rest = hot.where("own is null").join(placed, "grp").select("id", "size", "text_crc32", "shard")
    out = gapless_rank(materialize(one.unionAll(rest), "shard-placed"), ["shard"], ["id", "text_crc32"], "slot", parts)
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
