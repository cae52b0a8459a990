"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeshift.llm import bpe, exact_dedup, fill_middle, html_blocks, license_digest, ngram_join, packing, quality_rules, sharding, sphere_filters, url_filter, warc, whitening
from homeshift.llm.common import table


def op1_url_filter(spark, sf_dir):
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op2_sphere_filters(spark, sf_dir):
    return sphere_filters.embedding_components(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op3_ngram_join(spark, sf_dir):
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), k=5, percent=80)


def op4_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.score_documents(docs.select("doc_id", "text"), model).select("doc_id", "held_out", "score", "predicted")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file (a parameter of the operators; never copied)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_sharding(spark, sf_dir):
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_bpe(spark, sf_dir):
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_license_scan(spark, sf_dir):
    return license_digest.scan_licenses(table(spark, sf_dir, "documents"), license_digest.license_table(spark, digests=license_digest.known_digests()))


def op10_html_blocks(spark, sf_dir):
    return html_blocks.extract_text(table(spark, sf_dir, "pages"))


def op11_fill_middle(spark, sf_dir):
    return fill_middle.fill_middle_digests(table(spark, sf_dir, "documents"))


def op12_warc(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op13_whitening(spark, sf_dir):
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"), count=8)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def build():
    ops = {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}
    return {**dict(sorted(ops.items(), key=lambda x: int(x[0][2:].split("_")[0]))), "pipeline": pipeline}


def oracle():
    return {"op1_url_filter": url_filter.ORACLE_SQL, "op6_exact_dedup": exact_dedup.ORACLE_SQL, "op9_license_scan": license_digest.oracle_sql(), "op11_fill_middle": fill_middle.ORACLE_SQL, "op12_warc": warc.ORACLE_SQL}
