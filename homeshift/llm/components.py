"""Connected components of an edge table by alternating large-star and small-star steps.

Each round turns every edge towards the smallest known neighbour; the rounds
needed grow with the logarithm of the components' diameter.  Edges are written
to the shared checkpoint folder after every round, so no lineage grows and a
lost executor replays one round only.  Nothing is collected but two counters a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeshift.session import drop_scratch, scratch_path


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): ``component`` is the smallest node reachable; nodes without edges are left out.

    ``edges`` has two long columns ``a`` and ``b``; direction, copies and loops do not matter.
    """
    lo, hi = F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
    e, path = _write(edges.where("a != b").select(lo, hi).distinct(), "cc-edges")
    seen = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node moves to the node's smallest neighbour (or the node itself)
        sym = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.where("v > u").join(least, "u").where("m != v").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi")
        moved = small.where("lo != m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        new, new_path = _write(moved.unionAll(low.select(F.col("m").alias("lo"), "hi")).distinct(), "cc-edges")
        sums = new.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")).alias("h")).first()
        drop_scratch(e.sparkSession, path)
        e, path = new, new_path
        if seen == (sums["n"], sums["h"]):
            break
        seen = (sums["n"], sums["h"])
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return roots.unionAll(e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
