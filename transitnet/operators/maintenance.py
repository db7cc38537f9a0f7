"""Physical order, and rows that nothing refers to any more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitnet.functions.geo import grid16, morton


def z_order(edges: DataFrame, partitions: int | None = None) -> DataFrame:
    """Edges in Z-order of their boxes' middles, so that a window reads few row groups: range-partitioned, sorted inside.

    The extent comes from one aggregate; rows stay distributed.
    """
    x, y = (F.col("min_lon_e6") + F.col("max_lon_e6")) / 2, (F.col("min_lat_e6") + F.col("max_lat_e6")) / 2
    b = edges.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).first()
    if b["x0"] is None:
        return edges
    code = morton(grid16(x, b["x0"], max(b["x1"], b["x0"] + 1)), grid16(y, b["y0"], max(b["y1"], b["y0"] + 1)))
    rows = edges.withColumn("_z", code)
    rows = rows.repartitionByRange(partitions, "_z", "edge_id") if partitions else rows.repartitionByRange("_z", "edge_id")
    return rows.sortWithinPartitions("_z", "edge_id").drop("_z")


def unreferenced_shapes(shapes: DataFrame, patterns: DataFrame, pending: int) -> DataFrame:
    """Shapes that a pattern refers to; refused while patterns are pending, for those still need theirs."""
    if pending:
        raise ValueError(f"{pending} pattern(s) are pending and may need their shape")
    return shapes.join(patterns.where("shape_id is not null").select("shape_id"), "shape_id", "left_semi")


def referenced_ways(ways: DataFrame, traces: DataFrame) -> DataFrame:
    """Ways that a trace runs over."""
    return ways.join(traces.select(F.explode("way_ids").alias("way_id")).distinct(), "way_id", "left_semi")


def refuse_collapse(before: int, now: int, floor: float = 0.5) -> None:
    """A refresh that loses more than half of what there was is an outage, not a change."""
    if before and now < before * floor:
        raise ValueError(f"{now} rows where there were {before}: refused")


def scanned(df: DataFrame) -> dict[str, int]:
    """Rows and files that the scans of a DataFrame read when it runs: whether a layout lets a query prune."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    out = {"rows": 0, "files": 0}

    def walk(node) -> None:
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            walk(node.executedPlan())
            return
        if hasattr(node, "plan") and name.startswith(("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage")):
            walk(node.plan())
            return
        if name.startswith("Scan"):
            metrics = node.metrics()
            for key, metric in (("rows", "numOutputRows"), ("files", "numFiles")):
                if metrics.contains(metric):
                    out[key] += metrics.apply(metric).value()
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(plan)
    return out
