"""Corpus pipeline: quality classifier, exact dedup, n-gram Jaccard join, best-fit packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a table, which is written as Parquet and read again as the next stage's
``docs``.  All stages but the last return the columns of ``documents`` they were given.

Defined results, beyond those of the operators: rows without an id pass the dedup stages unless they copy
another row without id; of rows that repeat id and text one stays; rows that share an id but not the text stay or go
together in the near-duplicate stage; extra columns are carried along; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeshift.llm import exact_dedup, ngram_join, packing, quality_rules
from homeshift.llm.common import table
from homeshift.llm.queries import tokenizer_file
from homeshift.session import materialize, ship_package


def _carried(docs: DataFrame) -> DataFrame:
    """Id, text and the whole row as one column, so a column of any name passes a stage."""
    return docs.select(F.struct("*").alias("_doc"), "doc_id", "text")


def _rows(carried: DataFrame, docs: DataFrame) -> DataFrame:
    return carried.select(*[F.col("_doc")[c].alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return _rows(quality_rules.score_documents(_carried(docs), model).where("predicted = 1"), docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id.

    Rows that repeat id and text are one group of an aggregate with a map-side step, so a third of all rows being one
    such group is one row a task.
    """
    ship_package(spark)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_key")  # never null, so both sides meet by plain equality
    found = exact_dedup.exact_dedup(docs.select("doc_id", "text"))
    keep = found.where("kept").select(key, F.col("text_sha256").alias("_sha"))
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("_sha")
    once = _carried(docs).select(key, sha, "_doc").groupBy("_key", "_sha").agg(F.first("_doc").alias("_doc"))
    return _rows(once.join(keep, ["_key", "_sha"], "left_semi"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word shingles, Jaccard 0.8): the one with the smallest id."""
    ship_package(spark)
    found = ngram_join.ngram_components(docs.select("doc_id", "text"), k=5, percent=80)
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    carried = _carried(docs)
    named = carried.join(keep, F.col("doc_id") == F.col("_kept"), "left_semi")
    return _rows(named.unionByName(carried.where("doc_id is null")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    ship_package(spark)
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("best-fit packing", pack),
]

#: SQL can't express the tokenizer and the packing; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
