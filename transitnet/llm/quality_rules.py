"""Quality rules with adaptive thresholds: bounds from quantile sketches per language and source.

A sketch is a table of counts by logarithmic bucket (exact below 64, then 32 buckets for each doubling), so it
merges by addition, in any order, to the same result: sources merge into languages, languages into the whole. A document
is dropped if one of its ratios lies far outside its group's middle. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitnet.llm.common import SEPARATORS, WORD, checkpointed

#: Per-mille measures that have an upper bound, and by how much a bound exceeds its quantile at least.
MARGINS = {"symbols": 150, "repeats": 250, "lines": 250, "length": 1500}
#: A bound is q75 + SPREAD * (q75 - q50) + margin.
SPREAD = 6
#: Groups with fewer documents are judged by the sketch of their language, such languages by that of all.
LEAST_GROUP = 40

_SYMBOLS = "#*$%&|<>"


def base_measures(docs: DataFrame) -> DataFrame:
    """docs' (doc_id, lang, source) and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed.

    A null text has no words. Measured inside each row, by array functions: a text's words are never shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    many = lambda chars: F.coalesce(F.regexp_count(text, F.lit(f"[{chars}]")), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x, F.lit(SEPARATORS))) > 0)
    rows = docs.select(
        "doc_id", "lang", "source", words.alias("_w"), (F.length(text) - many(r"\x20\x09-\x0D")).cast("long").alias("word_chars"),
        many(_SYMBOLS).cast("long").alias("n_symbols"), lines.alias("_l"),
    )
    n = F.size("_w")
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))))
    rows = rows.select("*", F.coalesce(hashes, F.array().cast("array<bigint>")).alias("_h"))
    n_words = F.size("_w").cast("long")
    return rows.select(
        "doc_id", "lang", "source", n_words.alias("n_words"), "word_chars", "n_symbols",
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_h")) == F.size("_h"), F.lit(0)).otherwise(_repeated(F.col("_h"))).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _repeated(hashes: Column) -> Column:
    """How many words stand in 3-word windows whose hash occurs twice or more.

    The windows in the order of their hashes show which occur again; from their places in order, each adds the words up to the next, 3 at most.
    """
    let = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda s, x, i: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
    again = lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: same(s, x, i - 1) | same(s, x, i + 1)), lambda x: x["i"]))
    words = lambda at: F.aggregate(F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(3)), F.lit(3))), F.lit(0), lambda a, x: a + x)
    return let(pairs, lambda s: let(again(s), words))


def measures() -> dict[str, Column]:
    """Per-mille ratios of base_measures' columns; whole numbers, null where there is nothing to divide by."""
    over = lambda a, b: F.floor(F.try_divide(1000 * F.col(a), F.col(b))).cast("long")
    return {"symbols": over("n_symbols", "n_words"), "repeats": over("n_repeat_words", "n_words"), "lines": over("n_dup_lines", "n_lines"), "length": over("word_chars", "n_words")}


def bucket(x: Column) -> Column:
    """The sketch's bucket of a whole number from 0: itself below 64, then its 6 leading bits and their place."""
    places = F.greatest(F.length(F.bin(x)) - 6, F.lit(0))
    return F.when(x < 64, x).otherwise(32 * places + F.floor(x / F.pow(F.lit(2), places))).cast("long")


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n, most): counts of each bucket, and the largest value in it."""
    stacked = F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), v.alias("x")) for k, v in measures().items())))
    rows = rows.select("lang", "source", stacked.alias("m")).select("lang", "source", "m.measure", F.col("m.x").alias("x")).where("x is not null")
    return rows.groupBy("lang", "source", "measure", bucket(F.col("x")).alias("bucket")).agg(F.count("*").alias("n"), F.max("x").alias("most"))


def merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups, by addition."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"), F.max("most").alias("most"))


def bounds(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, docs, bound): the sketched quantiles' upper bound. A group has at most as many rows as there are buckets."""
    group = Window.partitionBy(*keys, "measure")
    ranked = sketch.select(*keys, "measure", "most", F.sum("n").over(group).alias("docs"), F.sum("n").over(group.orderBy("bucket")).alias("upto"))
    q = lambda share: F.min(F.when(100 * F.col("upto") >= share * F.col("docs"), F.col("most")))
    out = ranked.groupBy(*keys, "measure").agg(F.first("docs").alias("docs"), q(50).alias("q50"), q(75).alias("q75"))
    margin = F.element_at(F.create_map(*(F.lit(x) for kv in MARGINS.items() for x in kv)), F.col("measure"))
    return out.select(*keys, "measure", "docs", (F.col("q75") + SPREAD * (F.col("q75") - F.col("q50")) + margin).alias("bound"))


def _wide(table: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row for each group: its bounds by measure, where it has documents enough."""
    enough = F.when(F.col("docs") >= (LEAST_GROUP if name != "all" else 0), F.col("bound"))
    return table.groupBy(*keys).agg(*(F.max(F.when(F.col("measure") == k, enough)).alias(f"{name}_{k}") for k in MARGINS))


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every row.

    Thresholds come from the documents that pass the base rules. A null language or source is a group of its own. A null or
    empty text has no words and fails them; a very long one is measured whole, inside its row. Rows that repeat a doc_id are each measured and judged; other columns are ignored. An empty table gives no rows.
    """
    named = docs.select("doc_id", "text", F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("lang"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source"))
    rows = checkpointed(base_measures(named))
    fine = checkpointed(sketches(rows.where(~F.col("base_failed"))))
    own = _wide(bounds(fine, ["lang", "source"]), ["lang", "source"], "own")
    lang = _wide(bounds(merge(fine, ["lang"]), ["lang"]), ["lang"], "lang")
    every = _wide(bounds(merge(fine.withColumn("all", F.lit(1)), ["all"]), ["all"]), ["all"], "all")
    groups = own.join(lang, "lang").withColumn("all", F.lit(1)).join(every, "all")
    groups = groups.select("lang", "source", *(F.coalesce(f"own_{k}", f"lang_{k}", f"all_{k}").alias(f"_{k}") for k in MARGINS))
    within = F.lit(True)
    for k, x in measures().items():
        within = within & F.coalesce(x <= F.col(f"_{k}"), F.lit(True))
    return rows.join(groups, ["lang", "source"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & within).alias("kept")
    )
