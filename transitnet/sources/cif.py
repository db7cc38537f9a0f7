"""Fixed-width rail timetables (CIF): schedules with their calling points, from numbered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transitnet.functions.times import cif_date, cif_public

#: Record types that an extract may hold; fixed values.
KNOWN = ("HD", "TI", "TA", "TD", "AA", "BS", "BX", "LO", "LI", "LT", "CR", "ZZ")
#: Schedules' authority, highest first: cancellation, new, overlay, permanent; fixed values.
PRECEDENCE = ("C", "N", "O", "P")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, line) of one extract, in the file's order.

    The number follows the order of Spark's splits of the file, so it grows with the place in the file though it has gaps.
    """
    raw = spark.read.text(path).select(F.monotonically_increasing_id().alias("n"), F.rtrim("value").alias("line"))
    return raw.where(F.length(F.trim("line")) > 0)


def _cut(start: int, end: int) -> Column:
    return F.trim(F.substring("line", start + 1, end - start))


def check(rows: DataFrame) -> DataFrame:
    """rows themselves; raises on unknown records, update transactions, and files without a header first."""
    kind = F.substring("line", 1, 2)
    bad = rows.agg(
        F.min(F.when(~kind.isin(*KNOWN), F.struct("n", kind))).alias("unknown"),
        F.min(F.when((kind == "BS") & (F.substring("line", 3, 1) != "N"), F.col("n"))).alias("update"),
        F.min(F.when(kind == "HD", F.col("n"))).alias("head"),
        F.min("n").alias("first"),
    ).first()
    if bad["unknown"] is not None:
        raise ValueError(f"unknown record type {bad['unknown'][1]!r}")
    if bad["update"] is not None:
        raise ValueError("a BS record that isn't new: this is an update, not a full extract")
    if bad["head"] is None or bad["head"] != bad["first"]:
        raise ValueError("no HD header record first; this is not an extract")
    return rows


def schedules(rows: DataFrame) -> DataFrame:
    """One row for each BS record: its header, and its calls in order: array<struct<tiploc, public, platform>>.

    A schedule is a BS record and the locations up to the next; a running count of BS records says which. Only the count of each
    block of lines is summed over all lines, so no task holds the file.
    """
    rows = rows.withColumns({"kind": F.substring("line", 1, 2), "block": F.floor(F.col("n") / 65536)})
    rows = rows.where(F.col("kind").isin("BS", "LO", "LI", "LT"))
    within = F.sum((F.col("kind") == "BS").cast("long")).over(Window.partitionBy("block").orderBy("n"))
    blocks = rows.groupBy("block").agg(F.sum((F.col("kind") == "BS").cast("long")).alias("own"))
    before = blocks.select("block", (F.sum("own").over(Window.orderBy("block")) - F.col("own")).alias("before"))
    rows = rows.withColumn("within", within).join(before, "block").withColumn("schedule", F.col("within") + F.col("before"))
    inner = F.col("kind") == "LI"
    public = F.when(inner, cif_public(_cut(25, 29)) | cif_public(_cut(29, 33))).otherwise(cif_public(_cut(15, 19)))
    platform = F.nullif(F.when(inner, _cut(33, 36)).otherwise(_cut(19, 22)), F.lit(""))
    call = F.when(F.col("kind") != "BS", F.struct("n", _cut(2, 9).alias("tiploc"), public.alias("public"), platform.alias("platform")))
    head = F.when(
        F.col("kind") == "BS",
        F.struct(
            "n", _cut(3, 9).alias("uid"), _cut(9, 15).alias("runs_from"), _cut(15, 21).alias("runs_to"), _cut(21, 28).alias("days"), _cut(29, 30).alias("status"),
            _cut(30, 32).alias("category"), F.coalesce(F.nullif(_cut(79, 80), F.lit("")), F.lit("P")).alias("stp"),
        ),
    )
    out = rows.groupBy("schedule").agg(F.max(head).alias("h"), F.sort_array(F.collect_list(call)).alias("calls"))
    seven = F.when(F.regexp_like("h.days", F.lit("^[01]{7}$")), F.col("h.days")).otherwise(F.raise_error(F.concat(F.lit("days-run is not seven flags: "), F.col("h.days"))).cast("string"))
    return out.where("schedule > 0").select(
        "schedule", F.col("h.n").alias("n"), F.col("h.uid").alias("train_uid"), cif_date(F.col("h.runs_from")).alias("runs_from"), cif_date(F.col("h.runs_to")).alias("runs_to"),
        seven.alias("days"), F.col("h.stp").alias("stp"), F.col("h.status").alias("status"), F.col("h.category").alias("category"),
        F.transform("calls", lambda c: F.struct(c["tiploc"].alias("tiploc"), c["public"].alias("public"), c["platform"].alias("platform"))).alias("calls"),
    )


def tiplocs(rows: DataFrame) -> DataFrame:
    """(tiploc, description) of TI and TA records."""
    return rows.where(F.substring("line", 1, 2).isin("TI", "TA")).select(_cut(2, 9).alias("tiploc"), _cut(18, 44).alias("description"))


def calling_points(calls: Column) -> Column:
    """The places where passengers may board or alight, in order."""
    return F.transform(F.filter(calls, lambda c: c["public"]), lambda c: c["tiploc"])


def live(schedules: DataFrame, on: str) -> DataFrame:
    """The schedules in force on a day: of each train the most authoritative, none if that cancels it; of equals the first."""
    day = F.to_date(F.lit(on))
    runs = (F.col("runs_from") <= day) & (day <= F.col("runs_to")) & (F.get(F.split("days", ""), F.weekday(day)) == "1")
    rank = F.array_position(F.array(*map(F.lit, PRECEDENCE)), F.col("stp"))
    best = F.row_number().over(Window.partitionBy("train_uid").orderBy(rank, "n"))
    return schedules.where(runs).withColumn("_best", best).where("_best = 1 and stp <> 'C'").drop("_best")


def weekly_sequences(schedules: DataFrame) -> DataFrame:
    """(calls, schedules, trips): distinct calling sequences of two places or more, and their trips a week."""
    rows = schedules.select(calling_points(F.col("calls")).alias("calls"), F.length(F.translate("days", "0", "")).alias("days"))
    return rows.where(F.size("calls") >= 2).groupBy("calls").agg(F.count("*").alias("schedules"), F.sum("days").alias("trips"))


def tiplocs_used(schedules: DataFrame) -> DataFrame:
    return schedules.select(F.explode(calling_points(F.col("calls"))).alias("tiploc")).distinct()


def records(rows: DataFrame) -> DataFrame:
    """(kind, n): how many records of each type there are, to look into an extract."""
    return rows.groupBy(F.substring("line", 1, 2).alias("kind")).agg(F.count("*").alias("n"))
