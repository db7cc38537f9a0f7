"""Mixing sources to target weights by pivotal dependent rounding.

A document's expected copies are its source's target over its source's size. The whole part is taken; the fractional
parts are rounded by pairs: one of two documents gives mass to the other, at random and without changing either's
expectation, until one of them is 0 or 1. Blocks of documents of like size are folded pair by pair, and each hands the one
document that is left undecided to the next level, where blocks are folded again, up to one document for each source.
So a source's sum of copies stays what it was, and its words nearly so. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitnet.llm.common import WORD, checkpointed

#: Weights of the sources in the order of their names, repeating; what they share of all sizes; the most of one's own size.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Documents of a block, and blocks that the next level folds.
BLOCK, FAN_IN = 48, 64
#: Size classes for each doubling.
CLASSES = 12
#: Fractions nearer to 0 or 1 than this are whole.
NEAR = 1e-9

_DONE = "array<struct<unit:bigint,take:boolean>>"


def words_in(text: Column) -> Column:
    """The number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    Sources by code point, null last, weigh as ``weights``, repeating. They divide ``share`` of all sizes by weight; none gets
    more than ``most`` times its size, and what exceeds that is divided again among the rest.
    The sources are ranked in one task: one small row for each source, not for each document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, len(weights)) + 1).cast("int")).cast("double"))
    every = Window.partitionBy(F.lit(1))
    cap = most * F.col("source_size")
    filling = every.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    # Sources reach their bound in the order of size over weight. A source is bounded if, with those before it at
    # theirs, an even share of what is left would exceed its bound.
    left = share * F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    level = left / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    rows = rows.select("source", "source_size", "_w", level.alias("_level"), (level * F.col("_w") > cap).alias("_full"))
    open_level = F.min(F.when(~F.col("_full"), F.struct(F.col("source_size") / F.col("_w"), F.col("source").isNull(), "source", "_level"))).over(every)["_level"]
    return rows.select("source", "source_size", F.when(F.col("_full") | (F.col("source_size") == 0), cap).otherwise(F.least(cap, open_level * F.col("_w"))).alias("target"))


def _uniform(*parts: Column | str) -> Column:
    """A number from 0 to 1 that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def _fold(held: Column, seed: int) -> Column:
    """Fold an array of (order, unit, p) by pairs: struct(done, unit, p), p of ``unit`` being left undecided, or 0 or 1."""
    done = lambda unit, take: F.array(F.struct(unit.alias("unit"), F.lit(take).alias("take")))

    def step(s: Column, x: Column) -> Column:
        a, b, u = s["p"], x["p"], _uniform(F.lit(seed), s["unit"], x["unit"])
        both = a + b
        state = lambda d, unit, p: F.struct(F.concat(s["done"], d).alias("done"), unit.alias("unit"), p.alias("p"))
        keep_a = u * both < a  # for both < 1: one gets all, in proportion
        win_a = u * (2 - both) < 1 - b  # for both >= 1: one becomes 1, the other has the rest
        low = F.when(keep_a, state(done(x["unit"], False), s["unit"], both)).otherwise(state(done(s["unit"], False), x["unit"], both))
        high = F.when(win_a, state(done(s["unit"], True), x["unit"], both - 1)).otherwise(state(done(x["unit"], True), s["unit"], both - 1))
        return F.when(s["unit"].isNull(), F.struct(s["done"].alias("done"), x["unit"].alias("unit"), b.alias("p"))).when(both < 1, low).otherwise(high)

    nothing = F.struct(F.array().cast(_DONE).alias("done"), F.lit(None).cast("bigint").alias("unit"), F.lit(0.0).alias("p"))
    return F.aggregate(held, nothing, step)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 1) -> DataFrame:
    """docs with columns size, source_size, target and copies (long): how often the mix takes each document.

    size is the text's number of words, 0 for null. The draw depends on the ids, sizes, sources and ``seed`` alone, so reruns
    agree; documents of equal size are paired in the order of their ids' hashes. A null source is the last source. Rows that repeat a doc_id within a source draw together, as one document of
    their common size, and are taken alike; so do rows of a source without a doc_id. A document without words is taken as its
    source's whole part says. Other columns pass through; those of the four names are replaced. An empty table gives an empty one.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "_draw")
    sized = docs.withColumn("size", words_in(F.col("text")))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    units = checkpointed(sized.groupBy(key.alias("key"), F.col("source"), F.xxhash64(key, F.col("doc_id")).alias("unit")).agg(F.sum("size").alias("size")))
    sources = checkpointed(targets(units.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most))
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    whole = F.floor(ratio + NEAR)
    part = F.greatest(ratio - whole, F.lit(0.0))
    sources = sources.select("*", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"), whole.cast("long").alias("whole"), F.when(part < NEAR, 0.0).otherwise(part).alias("part"))

    # Blocks: documents of a source in one size class, dealt by hash over as many blocks as the class needs.
    grade = F.when(F.col("size") > 0, F.floor(F.log2(F.col("size").cast("double")) * CLASSES)).otherwise(-1).cast("long")
    graded = units.where("size > 0").select("key", "unit", "size", grade.alias("grade"))
    classes = graded.groupBy("key", "grade").agg(F.count("*").alias("n")).join(sources.where("part > 0").select("key", "part"), "key")
    classes = checkpointed(classes.select("key", "grade", "part", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks")))
    rows = graded.join(classes, ["key", "grade"]).select(
        "key", "grade", F.pmod(F.xxhash64("unit", F.lit(seed)), F.col("blocks")).alias("block"), "size", "unit", F.col("part").alias("p")
    )

    def level(rows: DataFrame, keys: list[str], order: list[str], number: int) -> DataFrame:
        held = F.sort_array(F.collect_list(F.struct(*order, "unit", "p")))
        return checkpointed(rows.groupBy(*keys).agg(_fold(held, seed * 1000 + number).alias("f")).select(*keys, "f.done", "f.unit", "f.p"))

    out = [now := level(rows, ["key", "grade", "block"], ["size"], 0)]
    most_blocks = classes.agg(F.max("blocks")).first()[0] or 0
    while most_blocks > 1:
        above = now.select("key", "grade", F.floor(F.col("block") / FAN_IN).alias("block"), F.col("block").alias("place"), "unit", "p")
        out.append(now := level(above, ["key", "grade", "block"], ["place"], len(out)))
        most_blocks = -(-most_blocks // FAN_IN)
    # At last the classes of a source, from the largest size down: at most 64 * CLASSES of them.
    out.append(now := level(now.select("key", (-F.col("grade")).alias("place"), "unit", "p"), ["key"], ["place"], len(out)))
    last = now.where("unit is not null").select("unit", (_uniform(F.lit(seed * 1000 + 999), "unit") < F.col("p")).alias("take"))
    taken = last.where("take").select("unit")
    for done in out:
        taken = taken.union(done.select(F.explode("done").alias("d")).where("d.take").select("d.unit"))
    taken = taken.withColumn("extra", F.lit(1))

    # Every row by its unit; a source's rows are many, its numbers one row.
    drawn = units.join(taken, "unit", "left").join(sources.select("key", "source_size", "target", "whole"), "key")
    drawn = drawn.select(F.col("unit").alias("_draw"), "source_size", "target", (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"))
    return sized.withColumn("_draw", F.xxhash64(key, F.col("doc_id"))).join(drawn, "_draw").select(*docs.columns, "size", "source_size", "target", "copies")


def expand(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row as often as its copies say."""
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*columns)
