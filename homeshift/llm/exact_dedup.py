"""Operator 6: exact deduplication by a tree merge of sorted digest runs.

Every row gets a number and a leaf by a hash of it.  A leaf's run holds its distinct
texts as (sha-256 digest, byte length, second hash, the row that stays, copies), sorted by
digest.  In each binomial round the runs of ``2 ** fan_bits`` neighbouring nodes meet and are
merged; equal entries collapse to the row (id, number) that stays.  A run is cut by the
first bits of the digest, so a round, the last one too, is spread over all tasks.  The winners
then travel back down the same tree, one join a level on (node, digest).

Skew: a text that fills a third of all rows, under many ids or under one, is one entry per leaf after the
first, local step and at most ``2 ** fan_bits`` entries per merge, upwards and downwards; its rows are spread evenly over the
leaves, so no join key is ever hot.  Only digests travel, never texts.

Verified: two rows are copies when sha-256, byte length and a 64-bit hash all agree.

Defined results: null text counts as empty; a null id is smaller than any other;
of rows that repeat both id and text exactly one is kept; very long texts are digested whole; an empty table gives
an empty result.  Extra columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeshift.llm.common import shuffle_partitions
from homeshift.session import materialize

KEY = ["digest", "n_bytes", "check"]


def digest_rows(docs: DataFrame, leaves: int, id_col: str, text_col: str) -> DataFrame:
    """(id, row, leaf, digest, n_bytes, check) of every row, written once so that texts are read once and row numbers stay."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), text.alias("b")).select(
        "id", "row",
        F.pmod(F.xxhash64("row"), F.lit(leaves)).cast("int").alias("leaf"),
        F.unhex(F.sha2("b", 256)).alias("digest"),
        F.octet_length("b").cast("long").alias("n_bytes"),
        F.xxhash64("b").alias("check"),
    )
    return materialize(rows, "dedup-digests")


def _cut(bits: int):
    """Part of the digest range: the first two bytes, cut into ``bits`` bits."""
    return F.shiftright(F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int"), 16 - bits)


def _merge(runs: DataFrame, node, parts: int, bits: int) -> DataFrame:
    """Exchange runs by (node, part of the digest range), sort, merge equal entries."""
    return (
        runs.withColumn("node", node)
        .withColumn("cut", _cut(bits))
        .repartition(parts, "node", "cut")
        .sortWithinPartitions("node", "cut", *KEY)
        .groupBy("node", "cut", *KEY)
        .agg(F.max("keep").alias("keep"), F.sum("copies").alias("copies"))
        .drop("cut")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaves: int | None = None, fan_bits: int = 3) -> DataFrame:
    """One row per input row: id, keep_id (largest id of its copies), group_size, kept, text_sha256.

    ``leaves``: first runs (default: the session's shuffle partitions);
    ``2 ** fan_bits`` runs meet in a round, so there are log(leaves) rounds.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    leaves = leaves or parts
    bits = max(1, min(16, (parts - 1).bit_length() + 2))
    rows = digest_rows(docs, leaves, id_col, text_col)
    first = rows.groupBy(F.col("leaf").alias("node"), *KEY).agg(F.max(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("copies"))
    levels = [first if leaves == 1 else materialize(first, "dedup-runs")]
    nodes = leaves
    while nodes > 1:
        nodes = ((nodes - 1) >> fan_bits) + 1
        levels.append(materialize(_merge(levels[-1], F.shiftright("node", fan_bits), parts, bits), "dedup-runs"))
    best = levels.pop()
    while levels:  # winners back down the tree
        own = levels.pop().select("node", *KEY).withColumn("up", F.shiftright("node", fan_bits))
        won = best.withColumnRenamed("node", "up")
        best = own.join(won, ["up", *KEY]).select("node", *KEY, "keep", "copies")
    return (
        rows.join(best.withColumnRenamed("node", "leaf"), ["leaf", *KEY])
        .select(
            F.col("id").alias(id_col),
            F.col("keep.id").alias("keep_id"),
            F.col("copies").alias("group_size"),
            (F.col("row") == F.col("keep.row")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


ORACLE_SQL = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
"""
