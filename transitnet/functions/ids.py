"""Identities and deterministic draws that other engines can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_id(key: Column) -> Column:
    """A 60-bit id of a text: the first 15 hex digits of its md5."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def pattern_id(route: Column, direction: Column, stops: Column) -> Column:
    """The id of (route, direction, stop sequence); nothing that varies between feeds enters it."""
    return text_id(F.concat(route, F.lit("|"), F.coalesce(direction.cast("string"), F.lit("")), F.lit("|"), F.array_join(stops, ">")))


def check_unique(df: DataFrame, key: str, identity: list[str]) -> DataFrame:
    """df itself; raises if two identities share a key. A collision must stop a build."""
    row = df.agg(F.count_distinct(key).alias("keys"), F.count_distinct(F.struct(*identity)).alias("rows")).first()
    if row["keys"] != row["rows"]:
        raise ValueError(f"{row['rows'] - row['keys']} {key} collision(s) among {row['rows']} rows")
    return df


def unit(key: Column, salt: str = "") -> Column:
    """A number from 0 to 1 from a key's md5."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit("|" + salt)).cast("binary")), 1, 13), 16, 10).cast("long") / float(1 << 52)


def sampled(key: Column, n: int) -> Column:
    """One key in n, by hash. A sampling operator: it decides which edges a preview draws, never a statistic."""
    if n < 1:
        raise ValueError(f"sample={n} must be 1 or more")
    return F.lit(True) if n == 1 else text_id(key.cast("string")) % n == 0


def shape_id(stops: Column) -> Column:
    """One shape for each distinct stop sequence."""
    return F.concat(F.lit("S"), F.substring(F.sha1(F.array_join(stops, "|").cast("binary")), 1, 16))
