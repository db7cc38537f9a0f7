"""Iterations over graphs as joins, their lineage cut by reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of checkpoints, which all executors share: spark.checkpoint.dir, or a temporary one only for a single-machine session."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if named := spark.conf.get("spark.checkpoint.dir", None):
            context.setCheckpointDir(named)
        elif context.master.startswith("local") and not context.master.startswith("local-cluster"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="transitnet-checkpoint-"))
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, which survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def follow(successors: DataFrame) -> DataFrame:
    """(id, chain, seq) from (id, next_id), each id having one successor and one predecessor at most.

    A chain is named after its head, the id without a predecessor; a loop after its smallest id, where it is entered. Pointer jumping:
    each round doubles how far back an id has seen, so a chain of n takes log2(n) joins.
    """
    back = successors.where("next_id is not null").select(F.col("next_id").alias("id"), F.col("id").alias("before"))
    ids = successors.select("id")
    # at: the farthest predecessor known; steps: how far; low: the least id seen from this one back to at.
    state = ids.join(back, "id", "left").select("id", F.coalesce("before", "id").alias("at"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("steps"), F.least("id", F.coalesce("before", "id")).alias("low"))
    heads = ids.join(back, "id", "left_anti").select(F.col("id").alias("at"), F.lit(True).alias("done"))
    state = checkpointed(state.join(heads, "at", "left").select("id", "at", "steps", "low", F.coalesce("done", F.lit(False)).alias("done")))
    total = state.count()
    reach = 1
    while reach < 2 * total and not state.where("not done").isEmpty():
        far = state.select(F.col("id").alias("at"), F.col("at").alias("at2"), F.col("steps").alias("steps2"), F.col("low").alias("low2"), F.col("done").alias("done2"))
        moved = state.where("not done").join(far, "at").select("id", F.col("at2").alias("at"), (F.col("steps") + F.col("steps2")).alias("steps"), F.least("low", "low2").alias("low"), F.col("done2").alias("done"))
        state = checkpointed(state.where("done").unionByName(moved))
        reach *= 2
    lines = state.where("done").select("id", F.col("at").alias("chain"), F.col("steps").alias("seq"))
    loops = state.where("not done").select("id", F.col("low").alias("chain"))
    if loops.isEmpty():
        return lines
    # Cut each loop before its least id; what is left are lines.
    cut = successors.join(loops, "id").where(F.col("next_id") != F.col("chain")).select("id", "next_id")
    opened = loops.select("id").join(cut, "id", "left").select("id", "next_id")
    return lines.unionByName(follow(opened))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b): the least node that it is connected with.

    Each round hooks every node to the least label around it and then jumps to that label's label; rounds stop when no
    label changes. Labels are combined before the shuffle, so a node with many edges is no hot key.
    """
    both = checkpointed(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node")
    labels = checkpointed(labels)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("new"))
        # The label itself moves to the least label that any of its nodes has found.
        roots = hooked.groupBy("label").agg(F.min("new").alias("root"))
        moved = hooked.join(roots, "label").select("node", F.least("new", "root").alias("label"), (F.least("new", "root") != F.col("label")).alias("moved"))
        jump = moved.select(F.col("node").alias("label"), F.col("label").alias("above"))
        moved = checkpointed(moved.join(jump, "label", "left").select("node", F.least("label", F.coalesce("above", "label")).alias("label"), "moved"))
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
