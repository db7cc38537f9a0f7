"""Plain versions of the contracts, row by row in Python."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def shingles(text, n=3):
    w = WORDS.findall((text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def jaccard_components(rows, n=3, num=90, den=100):
    """{doc_id: (n_shingles, component_id)} of unique doc_ids, all pairs that share a shingle being compared."""
    sets = {d: shingles(t, n) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    classes = defaultdict(list)
    for d, s in sets.items():
        classes[s].append(d)
    reps = [(s, min(ds)) for s, ds in classes.items() if s]
    for s, ds in classes.items():
        for d in ds:
            if s:
                root[d] = min(ds)
    holders = defaultdict(list)
    for k, (s, _) in enumerate(reps):
        for x in s:
            holders[x].append(k)
    for k, (s, d) in enumerate(reps):
        both = Counter()
        for x in s:
            for j in holders[x]:
                if j < k:
                    both[j] += 1
        for j, c in both.items():
            if den * c >= num * (len(s) + len(reps[j][0]) - c):
                a, b = find(d), find(reps[j][1])
                root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def line_dedup(rows, least=40, docs=5):
    """{doc_id: (n_lines, n_dropped, kept text)}"""
    holders = defaultdict(set)
    split = {}
    for d, t in rows:
        split[d] = [(line, line.strip(SPACE).translate(FOLD)) for line in (t or "").split("\n")]
        for _, k in split[d]:
            if len(k) >= least:
                holders[k].add(d)
    out = {}
    for d, lines in split.items():
        kept = [x for x, k in lines if len(k) < least or len(holders[k]) < docs or max(holders[k]) == d]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def base_rules(text):
    t = text or ""
    w = WORDS.findall(t)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    n, r = len(w), len(covered)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n


KINDS = (
    ("assign", re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 6),
    ("access", re.compile(r"(AKIA[A-Z0-9]+)"), 20),
    ("hex", re.compile(r"([0-9a-f]+)"), 24),
)


def base_secrets(text):
    out = []
    for k, (kind, pattern, least) in enumerate(KINDS):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if len(m[1]) >= least]
    return [x for _, _, x in sorted(out)]


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """{source: target}; what exceeds a bound is shared again until nothing does."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > most * sizes[s] or not sizes[s]}
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def crc_fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def tiktoken_encoding(path, pattern):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


#: Windows of each class: what all of one must be, what it must hold, and its least entropy.
CLASSES = (
    (re.compile(r"[0-9a-fA-F]+"), re.compile(r"[0-9].*[a-fA-F]|[a-fA-F].*[0-9]"), 3.0),
    (re.compile(r"[0-9A-Z]+"), re.compile(r"[0-9].*[A-Z]|[A-Z].*[0-9]"), 3.4),
    (re.compile(r"[0-9A-Za-z]+"), re.compile(r"[0-9].*[A-Za-z]|[A-Za-z].*[0-9]"), 3.6),
    (re.compile(r"[A-Za-z]+"), re.compile(r"[a-z].*[A-Z]"), 3.6),
    (re.compile(r"[0-9A-Za-z+/_=-]+"), re.compile(r"(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9]|.*[a-z][A-Z])"), 3.7),
)
NAME = r"(?:[A-Z]+|[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*)"
ALLOWED = [
    re.compile(p)
    for p in (
        r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", r"[0-9+/_=-]+", rf"{NAME}([+/_=-]+{NAME})*", rf"[+/_=-]*{NAME}[0-9]{{0,4}}([+/_=-]+{NAME}?[0-9]{{0,4}})*", r"(.{1,9})\1+.{0,9}",
    )
]


def entropy(s):
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def entropy_secrets(text, width=20):
    """(start, end) of joined windows of the candidates' parts beside base spans, each window's entropy worked out anew."""
    text = text or ""
    covered = [False] * len(text)
    for x in base_secrets(text):
        _, a, b = x.split(":")
        covered[int(a) : int(b)] = [True] * (int(b) - int(a))
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        for hidden, run in groupby(range(*m.span()), lambda i: covered[i]):
            run = list(run)
            part = text[run[0] : run[-1] + 1]
            if hidden or len(part) < width or any(p.fullmatch(part) for p in ALLOWED):
                continue
            joined = []
            for i in range(len(part) - width + 1):
                w = part[i : i + width]
                if any(fits.fullmatch(w) and holds.match(w) if "(?=" in holds.pattern else fits.fullmatch(w) and holds.search(w) for fits, holds, least in CLASSES if entropy(w) >= least):
                    if joined and joined[-1][1] >= i:
                        joined[-1][1] = i + width
                    else:
                        joined.append([i, i + width])
            out += [(run[0] + a, run[0] + b) for a, b in joined]
    return out


def xx(seed, *parts):
    """Spark's xxhash64 of strings and longs, each seeding the next; signed."""
    for p in parts:
        if p is not None:
            data = p.encode() if isinstance(p, str) else int(p).to_bytes(4, "little") if isinstance(p, Int) else (p & (1 << 64) - 1).to_bytes(8, "little")
            seed = xxhash.xxh64(data, seed=seed & (1 << 64) - 1).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def copies(rows, seed=1, block=48, fan_in=64, steps=12):
    """{(source, doc_id): copies} of rows (doc_id, source, size): pivotal rounding written out, one pair after another."""
    key = lambda s: "" if s is None else "=" + s
    total, sources = defaultdict(int), {}
    for d, s, n in rows:
        total[s, d] += n
    sizes = defaultdict(int)
    for (s, _), n in total.items():
        sizes[s] += n
    target = targets(sizes)
    sources = {s: target[s] / sizes[s] if sizes[s] else 0.0 for s in sizes}
    out, unit = {}, {}
    level = defaultdict(list)
    uniform = lambda seed, *units: ((xx(42, Int(seed), *units) & (1 << 64) - 1) >> 11) / (1 << 53)
    classes = Counter()
    grade = lambda n: math.floor(math.log(n) / math.log(2) * steps)
    for (s, d), n in total.items():
        whole = math.floor(sources[s] + 1e-9)
        out[s, d] = whole
        unit[xx(42, key(s), d)] = (s, d)
        if n and max(0.0, sources[s] - whole) >= 1e-9:
            classes[s, grade(n)] += 1
    for (s, d), n in total.items():
        part = max(0.0, sources[s] - math.floor(sources[s] + 1e-9))
        if n and part >= 1e-9:
            u = xx(42, key(s), d)
            level[s, grade(n), xx(42, u, Int(seed)) % -(-classes[s, grade(n)] // block)].append((n, u, part))

    def fold(held, number):
        u = p = None
        for _, v, q in sorted(held):
            if u is None:
                u, p = v, q
                continue
            draw, both = uniform(seed * 1000 + number, u, v), p + q
            if both < 1:
                u, p = (u if draw * both < p else v), both
            else:
                won = draw * (2 - both) < 1 - q
                out[unit[u if won else v]] += 1
                u, p = (v if won else u), both - 1
        return u, p

    number, most = 0, max((-(-n // block) for n in classes.values()), default=0)
    now = {k: fold(v, 0) for k, v in level.items()}
    while most > 1:
        number += 1
        above = defaultdict(list)
        for (s, g, b), (u, p) in now.items():
            above[s, g, b // fan_in].append((b, u, p))
        now, most = {k: fold(v, number) for k, v in above.items()}, -(-most // fan_in)
    number += 1
    last = defaultdict(list)
    for (s, g, _), (u, p) in now.items():
        last[s].append((-g, u, p))
    for held in last.values():
        u, p = fold(held, number)
        if uniform(seed * 1000 + 999, u) < p:
            out[unit[u]] += 1
    return out


class Int(int):
    """An integer of 4 bytes, as a literal is hashed."""


def crf_quality(chain, text):
    """The document's quality by forward and backward sums of plain probabilities, line by line."""
    from transitnet.llm.quality_crf import OWN, line_features

    lines = (text or "").split("\n")
    own = [line_features(x) for x in lines]
    none = [0.0] * OWN
    score = [sum(w * f for w, f in zip(chain.w, own[k] + (own[k - 1] if k else none) + (own[k + 1] if k + 1 < len(own) else none), strict=True)) for k in range(len(own))]
    weigh = lambda k, s: math.exp(score[k] * s)
    ahead = [[math.exp(chain.start[s]) * weigh(0, s) for s in (0, 1)]]
    for k in range(1, len(lines)):
        now = [sum(ahead[-1][r] * math.exp(chain.move[r][s]) for r in (0, 1)) * weigh(k, s) for s in (0, 1)]
        ahead.append([x / sum(now) for x in now])
    back = [[1.0, 1.0]]
    for k in range(len(lines) - 1, 0, -1):
        now = [sum(math.exp(chain.move[s][r]) * weigh(k, r) * back[-1][r] for r in (0, 1)) for s in (0, 1)]
        back.append([x / sum(now) for x in now])
    both = [(a[0] * b[0], a[1] * b[1]) for a, b in zip(ahead, back[::-1], strict=True)]
    return sum((len(x) + 1) * good / (bad + good) for x, (bad, good) in zip(lines, both, strict=True)) / sum(len(x) + 1 for x in lines)


def toxicity(model, text, width=10):
    """A text's score, window by window, word by word, n-gram by n-gram."""
    from transitnet.llm.toxicity import BUCKETS, GRAMS, PIECE, STRIDE

    mask = (1 << 64) - 1

    def bucket(h):
        h = (h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 & mask
        return (h ^ (h >> 32)) % BUCKETS

    def gain(word):
        found = []
        for piece in [word] if len(word) <= PIECE else [word[at : at + PIECE] for at in range(0, len(word) - STRIDE // 3, STRIDE)]:
            chars = [60, *map(ord, piece), 62]
            h = 7
            for c in chars:
                h = (h + c) * 0x9E3779B97F4A7C15 & mask
            found.append(bucket(h))
            for n in GRAMS:
                for at in range(len(chars) - n + 1):
                    h = n
                    for c in chars[at : at + n]:
                        h = (h + c) * 0x9E3779B97F4A7C15 & mask
                    found.append(bucket(h))
        gains = [float(model.gains[b]) for b in found]
        return sum(gains) / max(1, sum(g != 0 for g in gains))

    words = [w for w, _ in groupby(re.findall(r"\w+(?:[^\w\s]\w+)*", (text or "").lower()))]
    starts = [min(k, max(0, len(words) - width)) for k in range(0, len(words), width)]
    z = [model.bias + sum(gain(w) for w in words[s : s + width]) / min(width, len(words)) for s in starts] or [model.bias]
    clean = 1.0
    for x in z:
        clean *= 1 / (1 + math.exp(min(x, 500)))
    return 1 - clean
