"""Times and days of the feed formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def iso_seconds(duration: Column) -> Column:
    """Seconds of PnDTnHnMnS; 0 for what isn't one."""
    total = F.lit(0)
    shape = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)(?:\.\d+)?S)?)?$"
    for k, seconds in enumerate((86_400, 3_600, 60, 1), start=1):
        total = total + F.coalesce(F.regexp_extract(F.trim(duration), shape, k).try_cast("int"), F.lit(0)) * seconds
    return F.coalesce(total, F.lit(0))


def clock_seconds(clock: Column) -> Column:
    """Seconds of H:M:S, of which any may be missing; hours may exceed 24."""
    parts = F.split(F.coalesce(clock, F.lit("")), ":")
    n = lambda k: F.coalesce(F.get(parts, k).try_cast("int"), F.lit(0))
    return (n(0) * 60 + n(1)) * 60 + n(2)


def departure_seconds(clock: Column, day_shift: Column) -> Column:
    """A journey's first time; one with a day shift leaves after midnight of the day before's timetable."""
    return clock_seconds(clock) + F.when(F.length(F.trim(F.coalesce(day_shift, F.lit("")))) > 0, 86_400).otherwise(0)


def hhmmss(seconds: Column) -> Column:
    """HH:MM:SS, beyond 24 hours if need be."""
    two = lambda c: F.lpad(c.cast("long").cast("string"), 2, "0")
    return F.concat_ws(":", two(F.floor(seconds / 3600)), two(F.floor(seconds / 60) % 60), two(seconds % 60))


def week(names: Column, regular: Column) -> Column:
    """Seven 0/1 flags from the element names of an operating profile's days.

    names: array of names such as Monday, MondayToFriday, Weekend; null for no profile: Monday to Friday. An unknown name counts
    as Monday to Friday. A profile with regular days but no name runs on none.
    """
    def flag(k: int) -> Column:
        def hit(n: Column) -> Column:
            ends = [F.array_position(F.array(*map(F.lit, DAYS)), F.regexp_extract(n, r"^(\w+?)To(\w+)$", g)) for g in (1, 2)]
            spans = (ends[0] > 0) & (ends[1] > 0)
            known = n.isin(*DAYS, "Weekend") | spans
            return (n == DAYS[k]) | ((n == "Weekend") & F.lit(k > 4)) | (spans & (ends[0] <= k + 1) & (ends[1] >= k + 1)) | (~known & F.lit(k < 5))

        return F.when(names.isNull(), F.lit(int(k < 5))).otherwise(F.exists(names, hit).cast("int"))

    return F.array(*(flag(k) for k in range(7)))


def days_per_week(*flags: Column) -> Column:
    """The sum of seven 0/1 flags."""
    total = F.lit(0)
    for f in flags:
        total = total + F.coalesce(f.try_cast("int"), F.lit(0))
    return total


def cif_date(raw: Column) -> Column:
    """YYMMDD with a pivot at 60; 999999 is the end of time; anything else raises."""
    yy = F.substring(raw, 1, 2).try_cast("int")
    made = F.make_date(F.when(yy < 60, 2000 + yy).otherwise(1900 + yy), F.substring(raw, 3, 2).try_cast("int"), F.substring(raw, 5, 2).try_cast("int"))
    fine = F.regexp_like(raw, F.lit(r"^\d{2}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])$"))
    return F.when(raw == "999999", F.make_date(F.lit(9999), F.lit(12), F.lit(31))).when(fine, made).otherwise(F.raise_error(F.concat(F.lit("not a YYMMDD date: "), raw)).cast("date"))


def cif_public(raw: Column) -> Column:
    """Whether a public-time field holds a time: neither blank nor all zeros."""
    return F.regexp_like(F.coalesce(F.trim(raw), F.lit("")), F.lit("[^0]"))
