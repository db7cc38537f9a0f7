"""N-gram Jaccard join by a prefix tree: documents whose shingle sets overlap enough, as components.

The sets are ordered globally. Two sets that link share at least l of the first tokens of either
(n - required overlap + l of them), so a document whose first tokens are mostly held by it alone can link with
nothing and leaves early. What is left is gathered into small candidate families, and each family's sets, ordered
from its rarest to its most frequent token, go into a trie; every set is then run against the trie, sharing
partial overlaps between sets with equal beginnings and leaving subtrees whose remaining lengths can't reach
the overlap needed.

Equal sets are joined by their digest first and enter the search once. A family too large for one task, as common passages make
them, is sifted once more by all its tokens, and what is large even then is dealt out by shared token; a token's group above the bound is searched in chunks against a block of pivots, and only
what the pivots leave unconnected is searched against every chunk. So no task holds an unbounded group, no
pairs of a group are listed, and no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitnet.llm.common import checkpointed, chunks, components, given_back

#: Most documents, and most tokens in all their sets, that one trie holds; tokens of one piece of an edge.
UNIT_DOCS, UNIT_TOKENS, PIECE = 8192, 2_000_000, 16
#: About so many documents of an over-large token group are compared with all the group first.
PIVOTS = 64
#: Candidates whose ids are broadcast to pick their texts; more of them are joined by a shuffle of the texts.
BROADCAST = 500_000
#: Bytes of text that are hashed at once; a worker holds some fifty times as many for it.
SEGMENT = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += np.uint64(32)
_CODE = _mixed((_FOLD + np.uint64(1)) * _ODD)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_BASE, _INVERSE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(max(n, SEGMENT + 4096), base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def _hash_words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of the bytes."""
    inside = np.zeros(len(b) + 2, bool)
    inside[1:-1] = ~_SEPARATOR[b]
    change = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = change[::2], change[1::2]
    up, down = _powers(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_CODE[b] * up[: len(b)], dtype=np.uint64, out=total[1:])
    return start, _mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _ODD)


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """A 64-bit hash of each word of each text, A-Z taken as a-z; a text of any length is hashed in segments."""
    out: list[np.ndarray] = []
    for run in chunks(((t,) for t in texts), lambda x: len(x[0]) + 1, SEGMENT):
        if len(run) == 1 and len(run[0][0]) > SEGMENT:
            data, parts, at = np.frombuffer(run[0][0], np.uint8), [], 0
            while at < len(data):
                end = at + SEGMENT
                if end < len(data):  # cut behind a separator; a longer word makes a longer segment
                    back = np.flatnonzero(_SEPARATOR[data[at:end]])
                    if len(back):
                        end = at + int(back[-1]) + 1
                    else:
                        ahead = np.flatnonzero(_SEPARATOR[data[end:]])
                        end = end + int(ahead[0]) + 1 if len(ahead) else len(data)
                parts.append(_hash_words(data[at:end])[1])
                at = end
            out.append(np.concatenate(parts) if parts else np.zeros(0, np.uint64))
            continue
        start, h = _hash_words(np.frombuffer(b"\n".join(x[0] for x in run), np.uint8))
        ends = np.cumsum([len(x[0]) + 1 for x in run])
        out += np.split(h, np.searchsorted(start, ends[:-1]))
    return out


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct hashes of n-word shingles; the whole sequence is one if it is shorter."""
    if not len(words):
        return words
    k = min(n, len(words))
    h = np.full(len(words) - k + 1, np.uint64(k) * _ODD)
    for i in range(k):
        h = _mixed(h + words[i : len(words) - k + 1 + i]) * _ODD
    return np.unique(h)


def _least_overlap(n, num: int, den: int):
    """Of a set of n tokens with any that it links with."""
    return -(-n * num // den)


def _step(num: int, den: int) -> int:
    """Of how many tokens one more must be shared among the first: a prefix is a fifth of a set for 0.9, a quarter for 0.8."""
    return 10 if 10 * num >= 9 * den else 20


def _features(words: int, num: int, den: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.list_(pa.int64()))])
    step = _step(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1)), strict=True)
            for part in chunks(rows, lambda x: len(x[1] or b""), 4 * SEGMENT):
                ns, d1, d2, firsts = [], [], [], []
                for w in word_hashes([t or b"" for _, t in part]):
                    s = shingle_set(w, words)
                    n = len(s)
                    ns.append(n)
                    d1.append(int(s.sum(dtype=np.uint64).astype(np.int64)) if n else 0)
                    d2.append(int(_mixed(s ^ _ODD).sum(dtype=np.uint64).astype(np.int64)) if n else 0)
                    a = _least_overlap(n, num, den)
                    firsts.append(s[: n - a + n // step + 1].view(np.int64) if n and not _alone(n, num, den) else np.zeros(0, np.int64))
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, firsts)]).astype(np.int32), pa.array(np.concatenate(firsts)))
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in part], pa.int64()), pa.array(ns, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), lists], schema=schema)

    return run


def _alone(n: int, num: int, den: int) -> bool:
    """A set so small that one more token in the other breaks the link: it links with equal sets only."""
    return n * den < num * (n + 1)


def _sets(words: int):
    """Over rows (doc_id, text, unit): (doc_id, unit, tokens)."""
    schema = pa.schema([("doc_id", pa.int64()), ("unit", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1)), batch.column(2).to_pylist(), strict=True)
            for part in chunks(rows, lambda x: len(x[1] or b""), 2 * SEGMENT):
                sets = [shingle_set(w, words).view(np.int64) for w in word_hashes([t or b"" for _, t, _ in part])]
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, sets)]).astype(np.int32), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in part], pa.int64()), pa.array([x[2] for x in part], pa.int64()), lists], schema=schema)

    return run


class Trie:
    """A path-compressed trie of ordered token ranks, its nodes numbered by level; long edges are cut into pieces."""

    def __init__(self, seqs: list[np.ndarray], sizes: np.ndarray):
        """seqs: ascending ranks, in lexicographic order, none empty; sizes: how many tokens each whole set has."""
        ends, refs, parent, begin, final = [0], [0], [-1], [0], [[]]
        stack, before = [0], np.zeros(0, np.int64)

        def add(up: int, start: int, end: int, ref: int) -> int:
            parent.append(up)
            begin.append(start)
            ends.append(end)
            refs.append(ref)
            final.append([])
            return len(ends) - 1

        for i, s in enumerate(seqs):
            m = min(len(before), len(s))
            differ = np.flatnonzero(before[:m] != s[:m])
            common, popped = int(differ[0]) if len(differ) else m, -1
            while ends[stack[-1]] > common:
                popped = stack.pop()
            if ends[stack[-1]] < common:  # the way down ends inside an edge: split it
                node = add(stack[-1], begin[popped], common, refs[popped])
                parent[popped], begin[popped] = node, common
                stack.append(node)
            while common < len(s):
                stack.append(add(stack[-1], common, end := min(len(s), common + PIECE), i))
                common = end
            final[stack[-1]].append(i)
            before = s
        kids: list[list[int]] = [[] for _ in ends]
        for v in range(1, len(ends)):
            kids[parent[v]].append(v)
        order, child = [0], []
        for v in order:
            child.append((len(order), len(kids[v])))
            order += kids[v]
        count = len(order)
        place = {v: k for k, v in enumerate(order)}
        self.child, self.final = np.array(child), [final[v] for v in order]
        self.finals = np.array([len(x) for x in self.final])
        #: Of the sets below a node: the least and largest size, the most tokens still to come, and the last number.
        self.least, self.most, self.rest, self.last = np.full(count, 1 << 60), np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, -1)
        top = np.zeros(count, np.int64)
        for k in range(1, count):
            up = place[parent[order[k]]]
            top[k] = top[up] if up else k
        for k in range(count - 1, 0, -1):
            for i in self.final[k]:
                self.least[k], self.most[k], self.last[k] = min(self.least[k], sizes[i]), max(self.most[k], sizes[i]), max(self.last[k], i)
            up = place[parent[order[k]]]
            if up:
                self.least[up], self.most[up], self.last[up] = min(self.least[up], self.least[k]), max(self.most[up], self.most[k]), max(self.last[up], self.last[k])
                self.rest[up] = max(self.rest[up], self.rest[k] + ends[order[k]] - begin[order[k]])
        edges = [seqs[refs[v]][begin[v] : ends[v]] for v in order[1:]]
        self.length = np.array([0, *map(len, edges)])
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.tokens = np.concatenate(edges)
        self.top = np.zeros(len(seqs), np.int64)
        for k, own in enumerate(self.final):
            self.top[own] = top[k]
        self.seqs, self.sizes = seqs, sizes

    def links(self, num: int, den: int) -> Iterator[tuple[int, int]]:
        """Pairs (i, j), i < j, of sets whose intersection is num/den of their union or more.

        A set enters the subtrees that hold a set with which it shares one of the first tokens of both.
        """
        ranks = int(self.tokens.max()) + 1
        fewest = -(-self.sizes * num // den)
        heads = [s[: max(0, len(s) - f + 1)] for s, f in zip(self.seqs, fewest.tolist(), strict=True)]
        token, owner = np.concatenate(heads), np.repeat(self.top, [len(h) for h in heads])
        pairs = np.unique(np.stack([token, owner], axis=1), axis=0) if len(token) else np.zeros((0, 2), np.int64)
        cuts = np.searchsorted(pairs[:, 0], np.arange(ranks + 1))
        step = max(1, min(64, 4_000_000 // ranks))
        for at in range(0, len(self.seqs), step):
            entries = []
            for k, h in enumerate(heads[at : at + step]):
                nodes = np.unique(np.concatenate([pairs[cuts[t] : cuts[t + 1], 1] for t in h])) if len(h) else np.zeros(0, np.int64)
                entries.append((np.full(len(nodes), k), nodes))
            probe, node = (np.concatenate(x) for x in zip(*entries, strict=True))
            yield from self._descend(at, min(len(self.seqs), at + step), probe, node, fewest, ranks, num, den)

    def _descend(self, first: int, end: int, probe: np.ndarray, node: np.ndarray, every: np.ndarray, ranks: int, num: int, den: int) -> Iterator[tuple[int, int]]:
        probes = self.seqs[first:end]
        holds = np.zeros((len(probes), ranks), bool)
        for k, s in enumerate(probes):
            holds[k, s] = True
        keys = np.concatenate([k * ranks + s for k, s in enumerate(probes)])
        length = np.array([len(s) for s in probes])
        offset = np.cumsum(length) - length
        n, fewest = self.sizes[first:end], every[first:end]
        overlap = np.zeros(len(probe), np.int64)
        while len(probe):
            fits = (self.last[node] > probe + first) & (self.most[node] >= fewest[probe]) & (self.least[node] * num <= n[probe] * den)
            probe, node, overlap = probe[fits], node[fits], overlap[fits]
            if not len(probe):
                return
            kept: list[tuple] = []
            cuts = np.flatnonzero(np.diff(np.cumsum(self.length[node]) // 4_000_000)) + 1
            for p, v, o in zip(np.split(probe, cuts), np.split(node, cuts), np.split(overlap, cuts), strict=True):
                size = self.length[v]
                until = np.cumsum(size)
                token = self.tokens[np.repeat(self.start[v] - until + size, size) + np.arange(until[-1])]
                o = o + np.add.reduceat(holds[np.repeat(p, size), token].astype(np.int64), until - size)
                left = length[p] - (np.searchsorted(keys, p * ranks + token[until - 1], "right") - offset[p])
                need = -(-num * (n[p] + np.maximum(self.least[v], fewest[p])) // (num + den))
                fits = o + np.minimum(left, self.rest[v]) >= need
                kept.append((p[fits], v[fits], o[fits]))
            probe, node, overlap = (np.concatenate(x) for x in zip(*kept, strict=True))
            for k in np.flatnonzero(self.finals[node]):
                i, both = int(probe[k]), int(overlap[k])
                for j in self.final[node[k]]:
                    if j > i + first and den * both >= num * (int(n[i]) + int(self.sizes[j]) - both):
                        yield i + first, j
            begin, count = self.child[node, 0], self.child[node, 1]
            back = np.repeat(np.arange(len(probe)), count)
            node = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(len(back))
            probe, overlap = probe[back], overlap[back]


def unit_links(ids: list[int], sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among these sets.

    Tokens are ordered from the rarest here to the most frequent. Those of one set only are left out of the trie, for they are in no overlap;
    a set that has not enough others links with nothing.
    """
    sizes = np.array([len(s) for s in sets])
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.full(len(tokens), -1, np.int64)
    order = np.argsort(counts, kind="stable")
    order = order[counts[order] > 1]
    rank[order] = np.arange(len(order))
    seqs = [np.sort(x[x >= 0]) for x in np.split(rank[inverse], np.cumsum(sizes)[:-1])]
    some = [i for i in range(len(seqs)) if len(seqs[i]) * den >= num * sizes[i]]
    if len(some) < 2:
        return []
    some.sort(key=lambda i: seqs[i].astype(">u4").tobytes())
    seqs, sizes, ids = [seqs[i] for i in some], sizes[some], [ids[i] for i in some]
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in Trie(seqs, sizes).links(num, den):
        if (a := find(i)) != (b := find(j)):
            root[a] = b
            if ids[i] != ids[j]:
                out.append((ids[i], ids[j]))
    return out


def _search(num: int, den: int):
    """Over rows (unit, doc_id, tokens) that are sorted by unit: links (a, b)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
        now, ids, sets = None, [], []
        for batch in batches:
            tokens = batch.column(2)
            flat, cuts = tokens.values.to_numpy(), tokens.offsets.to_numpy()
            for k, (unit, doc) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if unit != now and ids:
                    yield ids, sets
                    ids, sets = [], []
                now = unit
                if cuts[k] < cuts[k + 1]:
                    ids.append(doc)
                    sets.append(flat[cuts[k] : cuts[k + 1]].copy())
        if ids:
            yield ids, sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        for ids, sets in units(batches):
            if len(ids) > 1:
                held += unit_links(ids, sets, num, den)
            if len(held) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*held, strict=True)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*held, strict=True)], schema=schema)

    return run


def _families(posts: DataFrame, least: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates by shared tokens. posts: (rep, n, token), of which two that link share ``least`` or more.

    A rep with fewer tokens that any other has can link with nothing. Of the rest, so many of the rarest are kept that
    two that link share one of them. Returns what is kept (rep, n, token), the tokens' groups of two or more, and the
    members (component, rep, n, k, weight) of the families that the groups make up, with their families' documents and tokens.
    """
    # Checkpointed, the counts are dealt out anew for the join, which adaptive execution can then split at a hot token.
    shared = checkpointed(posts.groupBy("token").agg(F.count("*").alias("c")).where("c > 1"))
    held = (
        posts.join(shared, "token")
        .groupBy("rep", "n")
        .agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("own"))
        .where(F.size("own") >= least)
        .select("rep", "n", F.explode(F.slice("own", 1, (F.size("own") - least + 1).cast("int"))).alias("t"))
    )
    held = checkpointed(held.select("rep", "n", F.col("t.token").alias("token")))
    groups = held.groupBy("token").agg(
        F.count("*").alias("k"), F.sum("n").alias("weight"), F.min("rep").alias("b"),
        F.bit_xor(F.xxhash64("rep")).alias("s1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("s2"),
    ).where("k > 1")
    groups = checkpointed(groups)
    family = components(held.join(groups, "token").select(F.col("rep").alias("a"), "b"))
    members = held.select("rep", "n").distinct().join(family, F.col("rep") == F.col("node"), "left")
    roots = family.select("component").distinct()
    members = members.select("rep", "n", F.coalesce("component", "rep").alias("component")).join(roots, "component", "left_semi")
    sizes = members.groupBy("component").agg(F.count("*").alias("k"), F.sum("n").alias("weight"))
    return held, groups, checkpointed(members.join(sizes, "component"))


def jaccard_components(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text).

    Two documents link when den * |intersection| >= num * |union| of their sets of ``words``-word shingles
    (A-Z as a-z; a shorter text's whole sequence is its one shingle). component_id is the smallest doc_id reachable by links.

    A null, empty or blank text has an empty set and links with nothing; a very long one is searched whole. Rows that repeat a doc_id
    are one node with the links of all of them, and each returns a row. A null doc_id returns a row with its n_shingles and a null
    component_id and links with nothing. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    feats = checkpointed(text.mapInArrow(given_back(_features(words, num, den)), "doc_id long, n long, d1 long, d2 long, first array<long>"))
    some = feats.where("n > 0 and doc_id is not null")
    reps = checkpointed(some.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")))

    # By the first tokens: who can link with whom at all. A small family of candidates is searched whole.
    least = F.ceil(F.col("n") * num / den)
    first = some.where(F.size("first") > 0).join(reps.select("d1", "d2", F.col("rep").alias("doc_id")), ["doc_id", "d1", "d2"], "left_semi")
    first = first.select(F.col("doc_id").alias("rep"), "n", F.explode("first").alias("token"))
    _, _, members = _families(first, F.floor(least / _step(num, den)) + 1)
    small = (F.col("k") <= UNIT_DOCS) & (F.col("weight") <= 2 * UNIT_TOKENS)
    unit = F.when(small, F.xxhash64(F.lit("family"), "component"))
    members = members.select(F.col("rep").alias("doc_id"), unit.alias("unit"))
    if members.count() <= BROADCAST:
        members = F.broadcast(members)
    sets = checkpointed(text.join(members, "doc_id").mapInArrow(given_back(_sets(words)), "doc_id long, unit long, tokens array<long>"))
    families, dealt, split = sets.where("unit is not null").select("unit", "doc_id", "tokens"), None, None
    large = sets.where("unit is null").select("doc_id", "tokens")
    if not large.isEmpty():
        # A large one may hang together by common passages. Again by all tokens, of which nearly all must be shared.
        whole = large.select(F.col("doc_id").alias("rep"), F.size("tokens").cast("long").alias("n"), F.explode("tokens").alias("token"))
        held, groups, members = _families(whole, least)
        dealt = members.where(small).select(F.xxhash64(F.lit("dense family"), "component").alias("unit"), "rep")
        # Families that are large even so are dealt out by token.
        distinct = groups.groupBy("k", "s1", "s2").agg(F.min("token").alias("token"), F.first("weight").alias("weight"))
        parts = F.greatest(F.ceil(F.col("k") / UNIT_DOCS), F.ceil(F.col("weight") / UNIT_TOKENS)).cast("long")
        rows = held.join(members.where(~small).select("rep").distinct(), "rep", "left_semi").join(distinct.select("token", "k", parts.alias("parts")), "token")
        rows = checkpointed(rows.select("token", "rep", "k", "parts", F.pmod(F.xxhash64("rep", F.lit(2)), "parts").alias("part")))
        dealt = dealt.union(rows.where("parts = 1").select(F.xxhash64(F.lit("token"), "token"), "rep"))
        split = rows.where("parts > 1")
        pivot = split.where(F.pmod(F.xxhash64("rep", F.lit(3)), F.greatest(F.floor(F.col("k") / PIVOTS), F.lit(1)).cast("long")) == 0)
        pivot = pivot.select("token", "rep", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        dealt = dealt.union(split.select("token", "rep", "part").union(pivot).distinct().select(F.xxhash64(F.lit("chunk"), "token", "part"), "rep"))

    def dealt_sets(units: DataFrame) -> DataFrame:
        return units.join(large, F.col("rep") == F.col("doc_id")).select("unit", "doc_id", "tokens")

    def searched(rows: DataFrame) -> DataFrame:
        return checkpointed(rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(given_back(_search(num, den)), "a long, b long"))

    links = searched(families if dealt is None else families.union(dealt_sets(dealt)))
    # A doc_id that stands over different texts links them.
    own = F.struct("d1", "d2", "n")
    several = some.groupBy("doc_id").agg(F.min(own).alias("one"), F.max(own).alias("other")).where("one <> other").select("doc_id")
    if not several.isEmpty():
        named = some.join(several, "doc_id", "left_semi").select("doc_id", "d1", "d2", "n").distinct().join(reps, ["d1", "d2", "n"])
        links = checkpointed(links.union(named.join(named.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b")))
    found = components(links)
    if split is not None and not split.isEmpty():
        # In each split group, all that the pivots have not joined with its largest component meets every chunk.
        now = split.join(found, F.col("rep") == F.col("node"), "left").select("token", "rep", "parts", "part", F.coalesce("component", "rep").alias("component"))
        now = checkpointed(now)
        main = now.groupBy("token", "component").agg(F.count("*").alias("k")).groupBy("token").agg(F.max(F.struct("k", "component")).alias("m"), F.sum("k").alias("all"))
        main = main.where("m.k < `all`").select("token", F.col("m.component").alias("main"), (F.col("all") - F.col("m.k")).alias("outside"), "all")
        now = now.join(main, "token").withColumn("outs", F.ceil(F.col("outside") * F.col("parts") / F.col("all")).cast("long"))
        if not now.isEmpty():
            each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
            every = now.select("token", "rep", "part", each("outs").alias("out"))
            rest = now.where("component <> main").select("token", "rep", each("parts").alias("part"), F.pmod(F.xxhash64("rep", F.lit(4)), "outs").alias("out"))
            again = every.union(rest).distinct().select(F.xxhash64(F.lit("rest"), "token", "part", "out").alias("unit"), "rep")
            found = components(links.union(searched(dealt_sets(again))))

    ends = reps.select("d1", "d2", "n", "rep").join(found, F.col("rep") == F.col("node"), "left").select("d1", "d2", "n", F.coalesce("component", "rep").alias("component_id"))
    rows = feats.select("doc_id", "n", "d1", "d2").join(ends, ["d1", "d2", "n"], "left")
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))).alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, **how) -> DataFrame:
    """docs without all but the smallest doc_id of each component; rows without a doc_id stay.

    Of rows that repeat a kept doc_id, all stay. Columns are those of docs.
    """
    rest = jaccard_components(docs, **how).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(rest, "doc_id", "left_anti").select(*docs.columns)
