"""Names: what two publishers' spellings agree on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Qualifiers that one publisher adds to a station's name and another leaves out, longest first; fixed values.
QUALIFIERS = (
    r"platforms? \d+(?: and \d+)*", "underground station", "rail station", "railway station", "tram stop", "dlr station",
    "metro station", "light railway station", "bus station", "ferry terminal", "station", "halt", "stop", "dlr", "underground",
)
PASSES = 4


def normalise(name: Column) -> Column:
    """A station name in lower case without apostrophes, punctuation and up to four trailing qualifiers; never emptied."""
    s = F.lower(F.coalesce(name, F.lit("")))
    s = F.regexp_replace(F.regexp_replace(s, "['’]", ""), r"[.,()\-/]", " ")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, "&", " and "), r"\s+", " "))
    bare = lambda v: F.trim(F.regexp_replace(v, r"\s*\b(" + "|".join(QUALIFIERS) + r")\s*$", ""))
    for _ in range(PASSES):
        # As a lambda's argument each pass is worked out once; written out, the expression would triple with each.
        s = F.element_at(F.transform(F.array(s), lambda v: F.when(F.length(bare(v)) > 0, bare(v)).otherwise(v)), 1)
    return s


def spellings(name: Column) -> Column:
    """Distinct forms that the other publisher may have written: with what is in brackets, and without."""
    return F.array_distinct(F.array(normalise(name), normalise(F.regexp_replace(name, r"\s*\([^)]*\)", ""))))


def operator_key(name: Column) -> Column:
    """An operator's name in lower case without accents, other marks taken as spaces."""
    s = F.translate(F.lower(name), ACCENTS[0], ACCENTS[1])
    return F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))


def _accents() -> tuple[str, str]:
    """Letters of Latin blocks that decompose into a plain letter and marks, and those plain letters."""
    import unicodedata

    pairs = [(c, unicodedata.normalize("NFKD", c)[0]) for c in map(chr, range(0xC0, 0x250)) if c == c.lower()]
    pairs = [(c, p) for c, p in pairs if c != p and p.isascii() and p.isalpha()]
    return "".join(c for c, _ in pairs), "".join(p for _, p in pairs)


ACCENTS = _accents()


def claimed(tag: Column, mine: list[str], others: list[str]) -> Column:
    """Whether a region draws what carries this operator tag: the first claimed of the names that ; or / separate decides."""
    named = F.transform(F.split(F.coalesce(tag, F.lit("")), "[;/]"), operator_key)
    known = F.filter(named, lambda n: n.isin([*mine, *others]))
    return F.when(F.size(known) == 0, F.lit(True)).otherwise(F.get(known, 0).isin(mine))


def display_name(short_name: Column, fallback: Column) -> Column:
    """A service's name; its route's id where it has none."""
    return F.coalesce(F.nullif(F.trim(short_name), F.lit("")), fallback)
