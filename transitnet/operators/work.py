"""Incremental work: what has no status is pending; statuses are added in batches, and some can be cleared."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitnet.operators.graph import checkpointed
from transitnet.schemas import MATCH_STATUS, ROAD_MODES, TRANSIENT
from transitnet.store import Store, unsent


def current_feed(version: str | None) -> Column:
    """Whether a pattern is in the feed of that version; never null."""
    return F.coalesce(F.col("last_seen") == F.lit(version), F.lit(False))


def matchable(patterns: DataFrame) -> Column:
    """Whether a pattern runs on roads. A table from before modes existed holds road patterns alone."""
    return F.col("mode").isNull() | F.col("mode").isin(*ROAD_MODES) if "mode" in patterns.columns else F.lit(True)


def non_road(patterns: DataFrame, version: str) -> Column:
    """Live, not on roads, and without a shape."""
    return current_feed(version) & ~matchable(patterns) & F.col("shape_id").isNull()


def traceable(patterns: DataFrame, version: str, over_shape: tuple[str, ...] = ("rail",)) -> Column:
    """As non_road(), and those of some modes though they have a shape."""
    return current_feed(version) & ~matchable(patterns) & (F.col("shape_id").isNull() | F.col("mode").isin(*over_shape))


def pending(items: DataFrame, status: DataFrame, key: str = "pattern_id", match_on: str | None = None) -> DataFrame:
    """Items without a status: one anti join, by shuffle, as there are about as many statuses as items in the end."""
    return items.join(unsent(status.select(F.col(match_on or key).alias(key))), key, "left_anti")


def busiest_first(items: DataFrame, limit: int, weight: str = "n_trips", key: str = "pattern_id") -> DataFrame:
    """The next batch of so many items: most trips first, null last, then by key. A top-k, not a sort of everything."""
    return items.orderBy(F.col(weight).desc_nulls_last(), F.col(key)).limit(limit)


def expand_statuses(names: list[str]) -> list[str]:
    """Status names, with "transient" for those that a retry may clear without being named."""
    out = [s for n in names for s in (TRANSIENT if n == "transient" else (n,))]
    if unknown := sorted(set(out) - set(MATCH_STATUS)):
        raise ValueError(f"unknown status(es) {', '.join(unknown)}; known: {', '.join(MATCH_STATUS)}, transient")
    return out


def retry(tables: dict[str, DataFrame], statuses: list[str], status_table: str = "match_status", key: str = "pattern_id") -> dict[str, DataFrame]:
    """The tables without the rows of items in those statuses, so that they are pending again. All tables are keyed alike."""
    cleared = unsent(tables[status_table].where(F.col("status").isin(expand_statuses(statuses))).select(key))
    return {name: df.join(cleared, key, "left_anti") for name, df in tables.items()}


def reclassify(status: DataFrame, fault: str, but: str) -> DataFrame:
    """Errors whose detail shows a transport fault, and isn't ``but``, become transport errors."""
    hit = (F.col("status") == "error") & F.col("detail").rlike(fault) & ~F.col("detail").like(but)
    return status.withColumn("status", F.when(F.coalesce(hit, F.lit(False)), "transport_error").otherwise(F.col("status")))


#: The key of each table that a batch adds to, and what a row does whose key is there already: a status takes the place of the
#: old one, an edge that another pattern brought stays, and a link can't be there twice.
CONFLICTS: dict[str, tuple[tuple[str, ...], str | None]] = {
    "match_status": (("pattern_id",), "replace"), "trace_status": (("pattern_id",), "replace"), "snap_status": (("pattern_id",), "replace"), "traces": (("pattern_id",), "replace"),
    "edges": (("edge_id",), "ignore"), "ways": (("way_id",), "ignore"), "pattern_edges": (("pattern_id", "seq"), None),
}


def run(
    store: Store,
    load: Callable[[int], DataFrame],
    process: Callable[[DataFrame], dict[str, DataFrame]],
    batch: int,
    limit: int | None = None,
    max_seconds: float | None = None,
) -> int:
    """Load a batch, process it and commit its rows to all its tables at once, until none is pending; returns items done.

    A batch is the unit that a lost job repeats. ``load(n)`` gives at most n pending items, ``process`` the rows for each table, of
    which the first holds one status for each item. Rows are added by CONFLICTS, so a batch that is repeated changes nothing
    and an edge that several patterns use is there once. A batch is loaded once and kept in the shared folder, as each of its tables
    reads it again.
    """
    done, began = 0, time.monotonic()
    while (limit is None or done < limit) and (max_seconds is None or time.monotonic() - began < max_seconds):
        items = checkpointed(load(min(batch, limit - done) if limit else batch))
        if items.isEmpty():
            break
        rows = process(items)
        added = store.insert_all({t: (r, *CONFLICTS[t]) for t, r in rows.items()})
        if not added[next(iter(rows))]:
            raise RuntimeError("a batch left no status; it would be loaded for ever")
        done += added[next(iter(rows))]
    return done


def pin_graph(store: Store, graph: str) -> None:
    """Refuse to mix edge ids of two builds of a routing graph: ids are scoped to the build."""
    known = store.meta("graph_id")
    if known is not None and known != graph and not store.read("match_status").isEmpty():
        raise ValueError(f"the stored edges are of graph {known}, the service has {graph}")
    store.set_meta("graph_id", graph)


def publishable(patterns: DataFrame, status: DataFrame) -> bool:
    """Whether nothing is pending and no transport error is left."""
    return pending(patterns, status).isEmpty() and status.where("status = 'transport_error'").isEmpty()


def summary(status: DataFrame, length: str | None = None, worst: str | None = None) -> DataFrame:
    """By status: items, and the summed kilometres and the worst metre figure if there are such columns."""
    more = [F.avg(worst).alias("mean_worst_m"), F.max(worst).alias("worst_m")] if worst else []
    more += [(F.sum(length) / 1000).alias("km")] if length else []
    return status.groupBy("status").agg(F.count("*").alias("items"), *more).orderBy(F.desc("items"), "status")
