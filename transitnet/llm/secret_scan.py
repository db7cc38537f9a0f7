"""Secret scan: fixed patterns, and sliding-window entropy by character class over candidate strings.

A candidate is a long run of the characters that keys are written in. A window moves over it one character at a time; the counts
of the characters inside change by one coming and one going, and the window's Shannon entropy follows from the change.
Windows that are more random than words of their class can be are secrets, unless an allow-list knows the candidate
(addresses, paths, dates, numbers, repeated patterns). DataFrame operations only.

All work is linear in a text's length: places are running sums taken by blocks, spans are laid over candidates by one sweep over their sorted
ends, a candidate is cut into stretches of bounded length, and no pattern repeats a group in a way that the engine would follow
by recursion. The README gives the recall on random keys.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (kind, pattern, group that must have so many characters, that number), in the order in which spans of one start are listed.
KINDS = (
    ("assign", r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", r"([0-9a-f]{24,})", 1, 24),
)
#: Strings that the entropy is measured in, the characters of a window, and the windows of a stretch.
CANDIDATE, WINDOW, STRETCH = r"[A-Za-z0-9+/_=-]{20,}", 20, 236
#: Bits of entropy that make a window of each class a secret; classes() says which windows are of a class.
LEAST_BITS = {"hex": 3.0, "upper": 3.4, "alnum": 3.6, "letters": 3.6, "mixed": 3.7}
#: A word in lower case, in capitals, or capitalised, also several written together in camel case.
_NAME = r"(?:[A-Z]++(?![a-z])|[A-Z]?[a-z]++(?:[A-Z][a-z]{2,}+)*+)"
#: Candidates that are known not to be secrets: UUIDs, dates and numbers, words and paths joined by marks, one piece repeated.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9+/_=-]++$",
    rf"^[+/_=-]*+{_NAME}[0-9]{{0,4}}+(?:[+/_=-]++{_NAME}?+[0-9]{{0,4}}+)*+$",
    r"^(.{1,9})\1++.{0,9}$",
)

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Counts up to WINDOW take 5 bits; a long holds 12 of them.
_BITS, _PER_LONG = 5, 12
_LONGS = -(-len(_ALPHABET) // _PER_LONG)
#: Fixed-point digits of n log2 n, so that sums are exact however long a window has moved.
_POINT = 1 << 40
#: Elements of a block of a running sum, and how many times blocks are summed by blocks; bits of a count of open spans.
_BLOCK, _LEVELS, _OPEN = 64, 3, 20

_SPAN = "array<struct<start:int,end:int>>"


def _let(value: Column, body) -> Column:
    """body(value), where value is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(x: str, levels: int = _LEVELS) -> str:
    """SQL for the running sums of an array of longs: by blocks, then by the sums of what blocks add up to, so linear in its size."""
    plain = lambda a: f"aggregate({a}, struct(cast(array() as array<bigint>) as out, 0L as at), (s, v) -> struct(concat(s.out, array(s.at + v)) as out, s.at + v as at), s -> s.out)"
    if not levels:
        return plain(x)
    a, b, c, j = (f"{n}{levels}" for n in "abcj")
    blocks = f"transform(sequence(0, cast((size({a}) - 1) div {_BLOCK} as int)), {j} -> {plain(f'slice({a}, {j} * {_BLOCK} + 1, {_BLOCK})')})"
    sums = _running(f"transform({b}, x -> element_at(x, -1))", levels - 1)
    joined = f"flatten(transform({b}, (x, {j}) -> transform(x, v -> v + if({j} > 0, get({c}, {j} - 1), 0L))))"
    many = f"transform(array({blocks}), {b} -> transform(array({sums}), {c} -> {joined})[0])[0]"
    return f"transform(array({x}), {a} -> if(size({a}) <= {_BLOCK}, {plain(a)}, {many}))[0]"


def _matches(text: Column, pattern: str, group: int) -> Column:
    """array<struct<gap, match, own>> of a pattern's leftmost matches: what lies before each, itself, and its group."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    wanted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = _let(F.split(text, pattern, -1), lambda between: F.slice(between, 1, F.size(between) - 1))
    # A text without a match, as nearly all are, is read once and no arrays are made.
    return F.when(F.regexp_like(text, F.lit(pattern)), F.arrays_zip(gaps.alias("gap"), matches.alias("match"), wanted.alias("own"))).otherwise(F.array().cast("array<struct<gap:string,match:string,own:string>>"))


def _spans(matches: str, least: int) -> Column:
    """array<struct<start, end, own>> of a column of matches, in code points; those whose group is too short are dropped."""
    ends = _running(f"transform({matches}, x -> cast(length(x.gap) + length(x.match) as bigint))")
    placed = f"zip_with({matches}, {ends}, (x, e) -> struct(cast(e as int) - length(x.match) as start, cast(e as int) as end, x.own as own))"
    return F.expr(f"if(size({matches}) > 0, filter({placed}, x -> length(x.own) >= {least}), cast(array() as array<struct<start:int,end:int,own:string>>))")


def _marks(char: str) -> int:
    """What a character adds to the counts of digits, capitals, small letters, marks and letters beyond f: 5 bits each."""
    at = (char.isdigit(), char.isupper(), char.islower(), char in "+/_=-", char.isalpha() and char.lower() > "f")
    return sum(1 << _BITS * k for k, holds in enumerate(at) if holds)


#: Where the count of a small letter with a capital behind it stands.
_CAMEL = 5


def _secret(marks: str, total: str) -> str:
    """SQL for whether a window with these counts is a secret; total is its sum of n log2 n over its characters' counts n."""
    has = lambda *at: f"({marks} & {sum(31 << _BITS * k for k in at)}L) <> 0"
    random = lambda kind: f"{total} <= {math.floor((math.log2(WINDOW) - LEAST_BITS[kind]) * WINDOW * _POINT)}L"
    digit, upper, lower, mark, beyond, camel = (has(k) for k in range(6))
    kinds = (
        f"not {mark} and not {beyond} and {digit} and {has(1, 2)}",
        f"{random('upper')} and not {mark} and not {lower} and {digit} and {upper}",
        f"{random('alnum')} and not {mark} and {digit} and {has(1, 2)}",
        f"{random('letters')} and not {mark} and not {digit} and {camel}",
        f"{random('mixed')} and {upper} and {lower} and ({digit} or {camel})",
    )
    return f"({random('hex')} and ({' or '.join(f'({k})' for k in kinds)}))"


def _stretch(s: str) -> str:
    """SQL for the windows of a string of bounded length that are secrets, array<struct<start, end>>, joined where they touch; from 0."""
    table = lambda values, kind: f"cast(array({', '.join(map(str, values))}) as array<{kind}>)"
    gains = table((round(_POINT * ((n + 1) * math.log2(n + 1) - (n * math.log2(n) if n else 0.0))) for n in range(WINDOW)), "bigint")
    slots = [max(0, _ALPHABET.find(chr(c))) for c in range(128)]
    word, shift = table((k // _PER_LONG for k in slots), "int"), table((_BITS * (k % _PER_LONG) for k in slots), "int")
    unit, mark = table((1 << _BITS * (k % _PER_LONG) for k in slots), "bigint"), table((_marks(chr(c)) for c in range(128)), "bigint")
    chars = f"transform(transform(split({s}, ''), c -> ascii(c)), c -> struct(c as code, get({word}, c) as word, get({unit}, c) as unit, get({shift}, c) as shift, get({mark}, c) as mark))"
    camel = lambda a, b: f"if({a}.code between 97 and 122 and {b}.code between 65 and 90, {1 << _BITS * _CAMEL}L, 0L)"
    # The i-th character that comes, the one that goes, and what they change of the marks; a pair of neighbours comes and goes with them.
    more = f"get(a, i).mark + if(i > 0, {camel('get(a, i - 1)', 'get(a, i)')}, 0L)"
    less = f"if(i >= {WINDOW}, get(a, i - {WINDOW}).mark + {camel(f'get(a, i - {WINDOW})', f'get(a, i - {WINDOW - 1})')}, 0L)"
    steps = f"transform(sequence(0, size(a) - 1), i -> struct(i as i, get(a, i) as come, get(a, i - {WINDOW}) as go, {more} - {less} as marks))"
    count = lambda counts, x: f"cast(shiftright(get({counts}, {x}.word), {x}.shift) & 31L as int)"
    changed = lambda counts, x, sign: f"transform({counts}, (n, k) -> if(k = {x}.word, n {sign} {x}.unit, n))"
    # Out first, so that no count exceeds the window.
    left = f"if(x.go is null, struct(t.counts as counts, t.total as total), struct({changed('t.counts', 'x.go', '-')} as counts, t.total - get({gains}, {count('t.counts', 'x.go')} - 1) as total))"
    now = f"struct({changed('r.counts', 'x.come', '+')} as counts, r.total + get({gains}, {count('r.counts', 'x.come')}) as total, t.marks + x.marks as marks)"
    # The span that windows are joined to, until one begins behind its end.
    start, end, hit = f"(x.i - {WINDOW - 1})", "x.i + 1", "m.hit"
    now = now.replace(" as marks)", f" as marks, x.i >= {WINDOW - 1} as full)")
    closed = "if(t.till is null, t.out, concat(t.out, array(struct(t.begin as start, t.till as end))))"
    opened = f"if({hit} and coalesce(t.till < {start}, true), struct({closed} as out, {start} as begin, {end} as till), struct(t.out as out, t.begin as begin, if({hit}, {end}, t.till) as till))"
    judged = f"struct(m.counts as counts, m.total as total, m.marks as marks, m.full and {_secret('m.marks', 'm.total')} as hit)"
    move = f"transform(transform(transform(array({left}), r -> {now}), m -> {judged}), m -> struct(m.counts as counts, m.total as total, m.marks as marks, {opened} as spans))[0]"
    move = f"transform(array({move}), m -> struct(m.counts as counts, m.total as total, m.marks as marks, m.spans.out as out, m.spans.begin as begin, m.spans.till as till))[0]"
    nothing = f"struct(array_repeat(0L, {_LONGS}) as counts, 0L as total, 0L as marks, cast(array() as {_SPAN}) as out, cast(null as int) as begin, cast(null as int) as till)"
    return f"transform(array({chars}), a -> aggregate({steps}, {nothing}, (t, x) -> {move}, t -> {closed}))[0]"


def _windows(s: str) -> str:
    """SQL for the windows of a candidate that are secrets, array<struct<start, end>>, joined where they touch; from 0.

    Stretches overlap by all but one character of a window, so each window is in one of them.
    """
    # A candidate is ASCII: cut as bytes, its stretches are found without counting characters.
    cut = f"cast(substring(cast({s} as binary), j * {STRETCH} + 1, {STRETCH + WINDOW - 1}) as string)"
    moved = f"transform({_stretch(cut)}, w -> struct(w.start + j * {STRETCH} as start, w.end + j * {STRETCH} as end))"
    spans = f"flatten(transform(sequence(0, cast((length({s}) - {WINDOW}) div {STRETCH} as int)), j -> {moved}))"
    starts = "filter(w, (x, i) -> coalesce(get(w, i - 1).end < x.start, true))"
    ends = "filter(w, (x, i) -> coalesce(get(w, i + 1).start > x.end, true))"
    return f"transform(array({spans}), w -> zip_with({starts}, {ends}, (x, y) -> struct(x.start as start, y.end as end)))[0]"


def _ends(candidates: Column, base: Column) -> Column:
    """The ends of all spans in order: array<struct<at, by>>; by adds to how many base spans are open (20 bits), how many candidates
    (20 bits), and the number of the last candidate begun."""
    end_of = lambda spans, which, by: F.transform(spans, lambda x: F.struct(x[which].alias("at"), F.lit(by).cast("bigint").alias("by")))
    return F.sort_array(F.concat(end_of(base, "start", 1), end_of(base, "end", -1), end_of(candidates, "start", (1 << _OPEN) + (1 << 2 * _OPEN)), end_of(candidates, "end", -(1 << _OPEN))))


def _uncovered(candidates: str, ends: str) -> Column:
    """array<struct<start, own>> of the parts of candidates that no base span covers and that hold a window; own is the part.

    One sweep over the ends of all spans, with a running sum of what is open behind each.
    """
    opened = _running(f"transform({ends}, x -> x.by)")
    spans = f"transform(zip_with({ends}, {opened}, (x, v) -> struct(x.at as at, v as open)), (x, i) -> struct(x.at as start, get({ends}, i + 1).at as end, x.open as open))"
    mask = (1 << _OPEN) - 1
    free = f"filter({spans}, x -> x.end - x.start >= {WINDOW} and (x.open & {mask}L) = 0 and (shiftright(x.open, {_OPEN}) & {mask}L) > 0)"
    own = f"get({candidates}, cast(shiftright(x.open, {2 * _OPEN}) as int) - 1)"
    # A candidate is ASCII: cut as bytes, its parts are found without counting characters.
    cut = f"cast(substring(cast({own}.own as binary), x.start - {own}.start + 1, x.end - x.start) as string)"
    return F.expr(f"if(size({candidates}) > 0, transform({free}, x -> struct(x.start as start, {cut} as own)), cast(array() as array<struct<start:int,own:string>>))")


def scan(docs: DataFrame) -> DataFrame:
    """docs' doc_id and secrets: array<struct<kind, start, end>>, code points with the end exclusive, in the order of start, then kind.

    kind is assign, access, hex or entropy; what a base span leaves of a candidate is scanned by itself, so no entropy span touches
    another. A null text is empty. A very long text, candidate or number of spans takes time in proportion.
    Every row is scanned by itself, whole; repeated rows give equal results; other columns are ignored. An empty table
    gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    searched = [*KINDS, ("cand", f"({CANDIDATE})", 1, WINDOW)]
    rows = docs.select("doc_id", text.alias("_t"))
    rows = rows.select("doc_id", *(_matches(F.col("_t"), p, g).alias(f"_{k}") for k, p, g, _ in searched))
    rows = rows.select("doc_id", *(_spans(f"_{k}", n).alias(f"_{k}") for k, _, _, n in searched))

    def tagged(number: int, kind: str) -> Column:
        return F.transform(f"_{kind}", lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end")))

    rows = rows.select("doc_id", F.concat(*(tagged(j, k) for j, (k, *_) in enumerate(KINDS))).alias("_base"), "_cand")
    rows = rows.select("*", F.when(F.size("_cand") > 0, _ends(F.col("_cand"), F.col("_base"))).alias("_ends"))
    rows = rows.select("doc_id", "_base", _uncovered("_cand", "_ends").alias("_part"))
    known = lambda s: F.exists(F.array(*(F.regexp_like(s, F.lit(p)) for p in ALLOWED)), lambda x: x)
    rows = rows.select("doc_id", "_base", F.filter("_part", lambda x: ~known(x["own"])).alias("_part"))
    found = f"transform(_part, p -> transform({_windows('p.own')}, w -> struct(p.start + w.start as start, {len(KINDS)} as kind, p.start + w.end as end)))"
    more = F.expr(f"if(size(_part) > 0, flatten({found}), cast(array() as array<struct<start:int,kind:int,end:int>>))")
    names = F.array(*(F.lit(k) for k, *_ in KINDS), F.lit("entropy"))
    found = rows.select("doc_id", F.sort_array(F.concat("_base", more)).alias("_s"))
    return found.select("doc_id", F.transform("_s", lambda x: F.struct(F.get(names, x["kind"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("secrets"))


def listed(secrets: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(secrets, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
