"""Edges joined end to end: directed successors, chains, and features coalesced by what they show."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitnet.operators.graph import checkpointed, components, follow


def successors(edges: DataFrame) -> DataFrame:
    """(id, next_id) from (id, from_node, to_node, weight): the edge that continues this one, or null.

    It starts where this one ends, with the same weight, and is there the only way on as this is the only way in; not itself.
    The weights are materialized once, so both sides of the join hold the same bits.
    """
    edges = checkpointed(edges.select("id", "from_node", "to_node", "weight"))
    into = edges.groupBy(F.col("to_node").alias("node"), "weight").agg(F.count("*").alias("n_in"))
    out = edges.groupBy(F.col("from_node").alias("node"), "weight").agg(F.count("*").alias("n_out"), F.min("id").alias("next_id"))
    joint = into.join(out, ["node", "weight"]).where("n_in = 1 and n_out = 1").select(F.col("node").alias("to_node"), "weight", "next_id")
    rows = edges.join(joint, ["to_node", "weight"], "left")
    return rows.select("id", F.when(F.col("next_id") != F.col("id"), F.col("next_id")).alias("next_id"))


def edge_ends(edges: DataFrame) -> DataFrame:
    """Edges of polylines as (id, from_node, to_node): a node is the micro-degree point itself."""
    point = lambda k: F.struct(F.element_at("lon_e6", k).alias("x"), F.element_at("lat_e6", k).alias("y"))
    return edges.select(F.col("edge_id").alias("id"), point(1).alias("from_node"), point(-1).alias("to_node"))


def chain_rows(edges: DataFrame, weights: DataFrame) -> DataFrame:
    """(edge_id, chain, seq, weight): runs of equal weight, to be drawn as one line each."""
    own = edge_ends(edges).join(weights.withColumnRenamed("edge_id", "id"), "id")
    return follow(successors(own)).join(weights, F.col("id") == F.col("edge_id")).select("edge_id", "chain", "seq", "weight")


def without_reverse(rows: DataFrame, id: str = "edge_id") -> DataFrame:
    """Of edges that are each other's reverse the one with the least id."""
    points = F.zip_with("lon_e6", "lat_e6", lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    back = F.reverse(points)
    rows = rows.withColumn("_key", F.when(points <= back, points).otherwise(back))
    first = rows.groupBy("_key").agg(F.min(id).alias(id)).select(id)
    return rows.join(first, id, "left_semi").drop("_key")


def joined_lines(members: list[tuple[int, list[tuple[int, int]]]], joints: set[tuple[int, int]] | None = None) -> list[tuple[int, list[tuple[int, int]]]]:
    """Undirected lines of (id, points) joined end to end through nodes that just two ends meet at; each named after its least id.

    A line runs from its lesser end to its greater; a ring starts with its least id's line. joints: those nodes, if lines that aren't members end at others.
    """
    ends: dict[tuple[int, int], list[int]] = {}
    lines = dict(sorted(members))
    for i, p in lines.items():
        for node in (p[0], p[-1]):
            ends.setdefault(node, []).append(i)
    left, out = set(lines), []

    def beyond(node: tuple[int, int]):
        """The lines that follow from a node on, each as it leaves it."""
        while (joints is None or node in joints) and len(ends[node]) == 2 and len(more := [j for j in ends[node] if j in left]) == 1:
            left.discard(more[0])
            p = lines[more[0]]
            p = p if p[0] == node else p[::-1]
            yield p
            node = p[-1]

    for i, p in lines.items():
        if i in left:
            left.discard(i)
            after = [q for line in beyond(p[-1]) for q in line[1:]]
            before = [q for line in beyond(p[0]) for q in line[1:]]
            run = [*before[::-1], *p, *after]
            out.append((i, run[::-1] if run[0] > run[-1] else run))
    return out


def coalesce(rows: DataFrame, keys: list[str], id: str = "edge_id") -> DataFrame:
    """Polylines that share ``keys`` joined end to end: (keys, id, lon_e6, lat_e6), named after the least id. Ids are unique.

    Lines that meet as the only two at a node of their keys are linked, and connected components of the links are found by joins; so a
    task holds what becomes one line, and not all lines that look alike, which may be most of a country.
    """
    rows = checkpointed(rows.select(*keys, id, "lon_e6", "lat_e6"))
    point = lambda k: F.struct(F.element_at("lon_e6", k).alias("x"), F.element_at("lat_e6", k).alias("y"))
    ends = rows.select(*keys, id, F.explode(F.array(point(1), point(-1))).alias("_node"))
    two = ends.groupBy(*keys, "_node").agg(F.count("*").alias("_n"), F.min(id).alias("_a"), F.max(id).alias("_b")).where("_n = 2 and _a <> _b")
    joints = checkpointed(two.select(F.col("_node").alias("node"), F.col("_a").alias("a"), F.col("_b").alias("b")))
    group = components(joints.select("a", "b")).select(F.col("node").alias(id), F.col("component").alias("_line"))
    # The nodes that a line is joined at, by line: two at most.
    joined = joints.select("node", F.explode(F.array("a", "b")).alias(id)).groupBy(id).agg(F.collect_set("node").alias("_joints"))
    work = rows.join(group, id, "left").join(joined, id, "left").withColumn("_line", F.coalesce("_line", id))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        members = [(int(i), list(zip(map(int, xs), map(int, ys), strict=True))) for i, xs, ys in zip(pdf[id], pdf["lon_e6"], pdf["lat_e6"], strict=True)]
        done = joined_lines(members, {(int(n["x"]), int(n["y"])) for own in pdf["_joints"] if own is not None for n in own})
        return pd.DataFrame({id: [i for i, _ in done], "lon_e6": [[x for x, _ in p] for _, p in done], "lat_e6": [[y for _, y in p] for _, p in done]})

    lines = work.where("_joints is not null").select("_line", id, "lon_e6", "lat_e6", "_joints").groupBy("_line").applyInPandas(run, f"{id} long, lon_e6 array<int>, lat_e6 array<int>")
    turned = point(1) > point(-1)
    alone = work.where("_joints is null").select(id, *(F.when(turned, F.reverse(c)).otherwise(F.col(c)).alias(c) for c in ("lon_e6", "lat_e6")))
    return rows.select(*keys, id).join(lines.union(alone), id).select(*keys, id, "lon_e6", "lat_e6")
