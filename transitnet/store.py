"""A data root: versioned Parquet snapshots of tables, and numbered manifests that name the folders in force.

Parquet has no transactions. A commit writes new folders and then puts the next manifest in place under a number that is not yet
taken, which is the one step that readers see. Nothing in force is touched before or after, so several tables change together or
not at all, and a job lost at any point leaves what was there. A table is one or several folders: rows that are added are
a folder more, not the table written anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitnet.schemas import TABLES, conform

#: Folders of a table before an addition merges them into one; manifests that are kept for readers that still use them.
MOST_PARTS, KEPT = 64, 3


class Store:
    """One region's data under ``root``, a path in any store that Spark writes to. One writer at a time; a second one fails."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str = "") -> list[str]:
        at = self._path(f"{self.root}/{folder}" if folder else self.root)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _numbers(self) -> list[int]:
        return sorted(int(n[9:-5]) for n in self._names() if n.startswith("manifest-") and n.endswith(".json"))

    def _manifest(self) -> tuple[int, dict[str, list[str]]]:
        """(number, table: folders) in force; (-1, {}) of a root that nothing was ever written to."""
        numbers = self._numbers()
        if not numbers:
            if any(v.startswith("v-") for t in self._names() if t in TABLES for v in self._names(t)):
                raise OSError(f"{self.root} holds data but no manifest")
            return -1, {}
        rows = self.spark.read.text(f"{self.root}/manifest-{numbers[-1]:09d}.json", wholetext=True).collect()
        return numbers[-1], json.loads(rows[0][0])

    def exists(self, table: str) -> bool:
        return table in self._manifest()[1]

    def read(self, table: str) -> DataFrame:
        """The table as it is now; empty if it was never written."""
        parts = self._manifest()[1].get(table)
        if not parts:
            return self.spark.createDataFrame([], TABLES[table])
        reader = self.spark.read.option("mergeSchema", len(parts) > 1)
        return conform(reader.parquet(*(f"{self.root}/{p}" for p in parts)), table)

    def _write(self, table: str, df: DataFrame, keys: Sequence[str] | None) -> str:
        part = f"{table}/v-{uuid.uuid4().hex[:12]}"
        writer = conform(df, table).write.mode("errorifexists")
        (writer.partitionBy(*keys) if keys else writer).parquet(f"{self.root}/{part}")
        return part

    def commit(self, changes: dict[str, DataFrame], partition_by: dict[str, Sequence[str]] | None = None, add: dict[str, DataFrame] | None = None) -> dict[str, int]:
        """Replace several tables and add rows to others, all at once; returns the number of rows added by table.

        All are written before the next manifest names any. Rows are added as they are: see insert() for keys.
        """
        number, manifest = self._manifest()
        if number < 0:
            # An empty manifest first: data without any is then a fault, not a new root.
            self._put(number := 0, {})
        for table, df in changes.items():
            manifest[table] = [self._write(table, df, (partition_by or {}).get(table))]
        added = {}
        for table, df in (add or {}).items():
            part = self._write(table, df, None)
            added[table] = self.spark.read.parquet(f"{self.root}/{part}").count()
            if added[table]:
                manifest[table] = [*manifest.get(table, []), part]
            if len(manifest.get(table, [])) > MOST_PARTS:
                whole = self.spark.read.option("mergeSchema", True).parquet(*(f"{self.root}/{p}" for p in manifest[table]))
                manifest[table] = [self._write(table, whole, None)]
        self._put(number + 1, manifest)
        self._clean()
        return added

    def _put(self, number: int, manifest: dict[str, list[str]]) -> None:
        """Put a manifest in place whole, under a number that nobody else has taken."""
        fresh, at = self._path(f"{self.root}/.manifest-{uuid.uuid4().hex[:12]}"), self._path(f"{self.root}/manifest-{number:09d}.json")
        out = self._fs.create(fresh, True)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        if self._fs.exists(at) or not self._fs.rename(fresh, at):
            self._fs.delete(fresh, False)
            raise OSError(f"{at.toString()} is there already: another writer is at work")

    def _clean(self) -> None:
        """Remove manifests but the last KEPT, and the folders that only those named. Folders that none names may be a writer's and stay."""
        numbers = self._numbers()
        old = [json.loads(self.spark.read.text(f"{self.root}/manifest-{n:09d}.json", wholetext=True).first()[0]) for n in numbers[:-KEPT]]
        kept = [json.loads(self.spark.read.text(f"{self.root}/manifest-{n:09d}.json", wholetext=True).first()[0]) for n in numbers[-KEPT:]] if old else []
        named = {p for m in kept for parts in m.values() for p in parts}
        for part in sorted({p for m in old for parts in m.values() for p in parts} - named):
            self._fs.delete(self._path(f"{self.root}/{part}"), True)
        for n in numbers[:-KEPT]:
            self._fs.delete(self._path(f"{self.root}/manifest-{n:09d}.json"), False)

    def insert(self, table: str, rows: DataFrame, keys: Sequence[str], conflict: str | None = None) -> int:
        """Add rows; returns how many. conflict: None fails on a key that is there, "ignore" keeps what is there, "replace" what comes."""
        return self.insert_all({table: (rows, keys, conflict)})[table]

    def insert_all(self, rows: dict[str, tuple[DataFrame, Sequence[str], str | None]]) -> dict[str, int]:
        """As insert(), into several tables at once. A table is written anew only if rows of it are replaced; else its new rows are added."""
        changes, add = {}, {}
        for table, (df, keys, conflict) in rows.items():
            if conflict not in (None, "ignore", "replace"):
                raise ValueError(f"conflict={conflict!r}; known: None, 'ignore', 'replace'")
            old, new = self.read(table), one_of_each(conform(df, table), keys)
            there = old.join(unsent(new.select(*keys)), list(keys), "left_semi")
            if conflict is None and (clash := there.select(*keys).first()):
                raise ValueError(f"a row of {table} with {clash.asDict()} is there already")
            if conflict == "replace" and not there.isEmpty():
                changes[table] = upsert(old, new, keys, conflict)
            else:
                add[table] = new.join(unsent(old.select(*keys)), list(keys), "left_anti") if conflict == "ignore" else new
        counts = self.commit(changes, add=add)
        return {t: counts[t] if t in counts else rows[t][0].select(*rows[t][1]).distinct().count() for t in rows}

    def rewrite(self, table: str, how) -> None:
        """Replace a table by ``how`` of itself, such as another order of rows; refused unless as many rows come out."""
        before = self.read(table)
        kept = self._manifest()[1].get(table)
        self.commit({table: how(before)})
        if (a := self.read(table).count()) != (b := before.count()):
            number, manifest = self._manifest()
            self._put(number + 1, manifest | {table: kept})
            raise ValueError(f"{table}: {a} rows where there were {b}; the old version is in force again")

    def meta(self, key: str) -> str | None:
        row = self.read("meta").where(F.col("key") == key).first()
        return row and row["value"]

    def set_meta(self, key: str, value: str) -> None:
        self.insert("meta", self.spark.createDataFrame([(key, value)], TABLES["meta"]), ["key"], "replace")


def unsent(rows: DataFrame) -> DataFrame:
    """rows as the right side of a join by key that shuffles and never sends them whole through the driver.

    Spark judges a table by its files' compressed bytes, shared out by declared widths, to which columns of nulls count in full:
    3 million statuses look smaller than 10 MB and are 197 MB when sent.
    """
    return rows.hint("merge")


def one_of_each(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows with one for each key: the least, by the other columns in their order."""
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    least = rows.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_least"))
    return least.select(*(F.col(c) if c in keys else F.col(f"_least.{c}") for c in rows.columns))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], conflict: str | None = None) -> DataFrame:
    """old and new rows together, by key."""
    keys = list(keys)
    if conflict is None:
        if clash := old.join(unsent(new), keys, "left_semi").select(*keys).first():
            raise ValueError(f"a row with {clash.asDict()} is there already")
        return old.unionByName(new)
    if conflict == "ignore":
        return old.unionByName(new.join(unsent(old), keys, "left_anti"))
    return old.join(unsent(new), keys, "left_anti").unionByName(new)
