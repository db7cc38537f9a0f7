"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitnet.llm import ann, bpe, line_dedup, mixing, ngram_join, quality_crf, quality_rules, secret_scan, toxicity, url_reputation

#: The vocabulary of the byte-level BPE queries, a file of the public tokenizers beside the interpreter's packages.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> tuple[str, str]:
    """(path, pattern) of the public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    outcomes = url_reputation.article_outcomes(pages, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return url_reputation.judge_urls(pages, outcomes).withColumn("bound", F.round("bound", 6))


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = _table(spark, sf_dir, "documents"), quality_crf.held_out(4, 2)
    chain = quality_crf.train(docs, _table(spark, sf_dir, "labels"), ~out)
    scored = quality_crf.score(docs.select("doc_id", "text"), chain)
    return scored.select("doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = _table(spark, sf_dir, "documents"), quality_crf.held_out(5, 0)
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), ~out)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op7_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = secret_scan.listed(F.filter("secrets", lambda x: x["kind"] != "entropy"))
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(base, 256).alias("base_sha256"), secret_scan.listed(F.col("secrets")).alias("spans"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), *vocabulary())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_ngram_jaccard_join, op2_url_reputation, op3_quality_crf, op4_line_dedup, op5_toxicity,
        op6_quality_rules, op7_learned_partitions, op8_mixing, op9_secret_scan, op10_bpe,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from transitnet.llm import sql

    return sql.ORACLES
