"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct words of a stretch of corpus are laid out as one array of tokens, with links to each token's neighbours, and an
inverted index leads from each pair of tokens to the places where it stands. The merges are replayed in the order of their ranks: each is
applied to all its places at once, and only the pairs that its new tokens form with their neighbours are added to
the index. Each document is then put together from its words' tokens.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from transitnet.llm.common import chunks, given_back

#: Characters of a stretch of text, distinct words that are merged together (more would leave the processor's cache), and
#: words that are remembered from one stretch to the next.
STRETCH, TOGETHER, MEMORY = 1_500_000, 1_500, 500_000


class Merges:
    """A vocabulary of ranks: token bytes, and the rank of each pair of tokens that merges."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.size = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        tokens = [b""] * self.size
        for t, r in ranks.items():
            tokens[r] = t
        self.tokens = np.array(tokens, object)
        self.merged: dict[int, int] = {}
        for t, r in ranks.items():
            for cut in range(1, len(t)):
                a, b = ranks.get(t[:cut]), ranks.get(t[cut:])
                if a is not None and b is not None:
                    self.merged[a * self.size + b] = r

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words end to end, how many each has); no word is empty."""
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        token = self.single[data].tolist()
        word = np.repeat(np.arange(len(words)), [len(w) for w in words]).tolist()
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for e in ends.tolist():
            after[e - 1] = -1
            if e < n:
                before[e] = -1
        size, merged = self.size, self.merged
        # The inverted index: places of the left token of each pair that merges, by pair; a place may be out of date.
        pairs = np.array(token[:-1], np.int64) * size + np.array(token[1:], np.int64)
        inside = np.ones(max(0, n - 1), bool)
        inside[ends[:-1] - 1] = False
        places = np.flatnonzero(inside)
        order = places[np.argsort(pairs[places], kind="stable")]
        distinct, first = np.unique(pairs[order], return_index=True)
        index = {p: at.tolist() for p, at in zip(distinct.tolist(), np.split(order, first[1:]), strict=True) if p in merged} if len(order) else {}
        # A rank may be that of several pairs; the queue holds the pairs by rank.
        queue = [(merged[p], p) for p in index]
        heapq.heapify(queue)
        while queue:
            rank, pair = heapq.heappop(queue)
            at = index.pop(pair, None)
            if at is None:
                continue
            left, right = divmod(pair, size)
            at.sort()
            later: list[int] = []
            waits = -1
            for i in at:
                if token[i] != left or (j := after[i]) < 0 or token[j] != right:
                    continue
                if word[i] == waits:  # an earlier merge of the word made a pair of a lower rank, which goes first
                    later.append(i)
                    continue
                token[i], token[j] = rank, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    p = rank * size + token[k]
                    if (r := merged.get(p)) is not None:
                        if p in index:
                            index[p].append(i)
                        else:
                            index[p] = [i]
                            heapq.heappush(queue, (r, p))
                        if r < rank:
                            waits = word[i]
                if (h := before[i]) >= 0:
                    p = token[h] * size + rank
                    if (r := merged.get(p)) is not None:
                        if p in index:
                            index[p].append(h)
                        else:
                            index[p] = [h]
                            heapq.heappush(queue, (r, p))
                        if r < rank:
                            waits = word[i]
            if later:
                index[pair] = index.get(pair, []) + later
                heapq.heappush(queue, (rank, pair))
        flat = np.array(token, np.int64)
        left_over = np.cumsum(flat >= 0)
        return flat[flat >= 0].astype(np.int32), np.diff(left_over[ends - 1], prepend=0)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.tokens[ids])


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Merges:
    """One vocabulary for each Python worker."""
    return Merges(path, pattern)


class Numbers(dict):
    """Words numbered as they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Encoder:
    """Encodes stretches of texts, remembering frequent words between them."""

    def __init__(self, merges: Merges):
        self.merges, self.known = merges, Numbers()
        self.flat, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > MEMORY:
            self.known, self.flat, self.length = Numbers(), self.flat[:0], self.length[:0]
        known, find = self.known, self.merges.find
        had = len(known)
        rows, counts = [], []
        for t in texts:
            own = find(t)
            rows += map(known.__getitem__, own)
            counts.append(len(own))
        if len(known) > had:
            new = list(islice(known, had, None))
            done = [self.merges.encode_words([w.encode("utf-8", "surrogatepass") for w in new[at : at + TOGETHER]]) for at in range(0, len(new), TOGETHER)]
            self.flat = np.concatenate([self.flat, *(ids for ids, _ in done)])
            self.length = np.concatenate([self.length, *(n for _, n in done)])
            self.start = np.cumsum(self.length) - self.length
        if not rows:
            return [np.zeros(0, np.int32) for _ in texts]
        row = np.array(rows)
        length = self.length[row]
        until = np.cumsum(length)
        ids = self.flat[np.repeat(self.start[row] - until + length, length) + np.arange(until[-1])]
        cuts = np.cumsum(counts)[:-1]
        return np.split(ids, np.concatenate([[0], until])[cuts])


def _encoded(batches: Iterator[pa.RecordBatch], at: int, merges: Merges) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Stretches of the batches with the ids of their texts, which stand in column ``at``."""
    encoder = Encoder(merges)
    for batch in batches:
        begin = 0
        for part in chunks(((t.as_py() or "",) for t in batch.column(at)), lambda t: len(t[0]), STRETCH):
            yield batch.slice(begin, len(part)), encoder.encode([t for (t,) in part])
            begin += len(part)


def encode(docs: DataFrame, path: str, pattern: str, name: str = "ids", decoded: str | None = "decoded") -> DataFrame:
    """docs with the column ``name``, the text's token ids, and ``decoded``, the bytes that the ids stand for.

    A null text counts as empty and has no ids. Special tokens are ordinary text. Every row is encoded by itself, whole.
    Other columns pass through; those of the new names are replaced. An empty table gives an empty one. ``path`` is read by each
    worker.
    """
    docs = docs.drop(name, *([decoded] if decoded else []))
    at, names = docs.columns.index("text"), [*docs.columns, name, *([decoded] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load(path, pattern)
        for own, ids in _encoded(batches, at, merges):
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            columns = [*own.columns, pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))]
            if decoded:
                columns.append(pa.array([merges.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    added = [StructField(name, ArrayType(IntegerType())), *([StructField(decoded, BinaryType())] if decoded else [])]
    return docs.mapInArrow(given_back(run), StructType([*docs.schema.fields, *added]))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: what encode() gives, hashed where it is made.

    The ids are hashed as little-endian unsigned 32-bit integers.
    """
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load(path, pattern)
        for own, ids in _encoded(batches, 1, merges):
            sums = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]
            back = [hashlib.sha256(merges.decode(x)).hexdigest() for x in ids]
            yield pa.RecordBatch.from_arrays([own.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(sums), pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, StructType([rows.schema["doc_id"]]).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string"))
