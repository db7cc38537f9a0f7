"""What several operators of this subpackage share: lineage cuts, bounded training samples, components."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, in every contract of this subpackage: a run of anything but the six ASCII separators.
WORD = r"[^\x20\x09-\x0D]+"
#: The separators themselves, for strip() and translate().
SEPARATORS = "\x20\x09\x0a\x0b\x0c\x0d"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in spark.checkpoint.dir; a temporary one only for a single-machine session."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local") and not context.master.startswith("local-cluster"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="transitnet-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def given_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, whose worker gives back what Arrow's pool keeps when a task ends: it stays for the next one, beside the JVM."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return tidied


def chunks(items: Iterable[tuple], weight, most: int) -> Iterator[list[tuple]]:
    """Runs of items whose weights add up to about ``most``; one heavier item is a run of its own."""
    held, total = [], 0
    for item in items:
        w = weight(item)
        if held and total + w > most:
            yield held
            held, total = [], 0
        held.append(item)
        total += w
    if held:
        yield held


def in_fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def training_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int, longest: int) -> list[tuple[str, int]]:
    """At most ``most`` labelled texts of at most ``longest`` characters, half of them of each label at most.

    ``usable`` says, over labels, which rows may be learnt from. A doc_id with several labels counts as its
    largest. Which are taken, and their order, is fixed by the ids' hashes. ``most`` bounds both the ids that are broadcast
    and the texts that reach the driver.
    """
    ids = (
        labels.where(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.max(label) > 0).cast("int").alias("_y"))
        .withColumn("_h", F.xxhash64("doc_id"))
    )
    first = lambda y: ids.where(F.col("_y") == y).orderBy("_h", "doc_id").limit(most // 2)
    rows = (
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull() & (F.length("text") <= longest))
        .join(F.broadcast(first(0).union(first(1))), "doc_id")
        .select("_h", "doc_id", "text", "_y")
        .orderBy("_h", "doc_id", "text")
        .limit(most)
        .toPandas()
    )
    return list(zip(rows["text"].tolist(), (int(y) for y in rows["_y"]), strict=True))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), for all nodes but each component's smallest.

    Alternates large-star and small-star steps, each a min-aggregation (combined map-side) and a join on the node, until
    the edges no longer change; then every edge leads from a node to the smallest of its component. A node with
    very many edges only lengthens a join side that adaptive execution splits. Each round is checkpointed.
    """
    e = checkpointed(
        edges.where("a <> b and a is not null and b is not null").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())

    seen = mark(e)
    while seen[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        e = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = checkpointed(moved.union(least.select("a", F.col("m").alias("b"))).distinct())
        now = mark(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
