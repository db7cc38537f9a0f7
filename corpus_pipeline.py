"""A training corpus from documents: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitnet.llm import bpe, line_dedup, mixing, ngram_join, quality_crf, toxicity
from transitnet.llm.common import checkpointed
from transitnet.llm.queries import vocabulary

#: A document of this score or more is rejected as toxic.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject. It learns from the labels of the documents that are there."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~quality_crf.held_out(5, 0))
    return toxicity.score(docs, model, "__toxicity").where(F.col("__toxicity") < TOXIC).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that many of them repeat."""
    kept = line_dedup.dedup_lines(docs)
    return kept.select(*(F.length("text").cast("long").alias("n_chars") if c == "n_chars" else c for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return ngram_join.keep_one_of_each(docs, words=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights; a document taken twice is there twice."""
    return mixing.expand(mixing.mix(docs), docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, with its number of tokens and whether the ids decode to its text."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), *vocabulary())
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return encoded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: No SQL: the first and the fourth stage learn and draw, the third needs all links of a graph. Tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result checkpointed before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = checkpointed(docs)
    return docs
