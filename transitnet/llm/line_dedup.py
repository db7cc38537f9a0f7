"""Line dedup: two Bloom filters find suspects, an exact count of the suspects decides.

One pass fills, in each partition, a filter of hashes seen once and one of hashes seen twice; partial filters merge piece
by piece (seen twice: in either's twice, or in both's once). The merged "twice" filter has a fixed bound and goes to
all executors. A second pass sends only the hashes that it holds through a shuffle, where they are counted exactly,
so the filter's false positives cost time but change nothing, and a filter that a larger corpus fills up sends more. Texts stay
where they are: the confirmed hashes, with the document that keeps each line, go to all executors if they are few, and beyond a
bound only documents that hold one are shuffled, found by a third filter of their ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from transitnet.llm.common import SEPARATORS, checkpointed, given_back

#: Bits of a filter: one for each BYTES_A_BIT bytes of input that the plan expects, between these powers of two.
BYTES_A_BIT, LEAST_BITS, MOST_BITS = 16, 1 << 18, 1 << 28
#: Columns that exist between the join and the result.
DROPS, DROP_ID = "__line_dedup_drops", "__line_dedup_id"
#: Bytes of a piece of a filter; a batch of 10,000 pairs of them is 40 MB at most.
PIECE = 1 << 11
PIECES = pa.schema([("piece", pa.int64()), ("once", pa.binary()), ("twice", pa.binary())])
#: Bits set for each hash.
PROBES = 4
#: Confirmed hashes that are sent to all executors, 24 bytes each.
BROADCAST = 500_000


def _key(line: str) -> str:
    return line.strip(SEPARATORS)


def _hashed(text: str | None, least_chars: int) -> dict[bytes, int]:
    """128-bit hashes of a text's eligible lines, and how often each occurs."""
    out: dict[bytes, int] = {}
    for line in (text or "").split("\n"):
        if len(line) >= least_chars and len(key := _key(line)) >= least_chars:
            h = xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())  # bytes: A-Z alone
            out[h] = out.get(h, 0) + 1
    return out


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(len, PROBES) bit numbers for rows of two uint64."""
    a, b = hashes[:, 0], hashes[:, 1] | np.uint64(1)
    return ((a[:, None] + np.arange(PROBES, dtype=np.uint64) * b[:, None]) & np.uint64(bits - 1)).astype(np.int64)


class Seen:
    """The two filters."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def _holds(self, table: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool).all(axis=1)

    def _put(self, table: np.ndarray, at: np.ndarray) -> None:
        flat = at.ravel()
        np.bitwise_or.at(table, flat >> 3, np.left_shift(np.uint8(1), (flat & 7).astype(np.uint8)))

    def add(self, hashes: np.ndarray) -> None:
        """Rows of two uint64, one for each document that holds the line."""
        if not len(hashes):
            return
        distinct, counts = np.unique(hashes, axis=0, return_counts=True)
        at = _places(distinct, self.bits)
        again = self._holds(self.once, at) | (counts > 1)
        self._put(self.twice, at[again])
        self._put(self.once, at)

    def may_repeat(self, hashes: np.ndarray) -> np.ndarray:
        return self._holds(self.twice, _places(hashes, self.bits))

    def packed(self) -> tuple[bytes, bytes]:
        return zlib.compress(self.once.tobytes(), 1), zlib.compress(self.twice.tobytes(), 1)

    def pieces(self) -> pa.RecordBatch:
        """(number, once, twice) of the pieces that hold anything."""
        some = np.flatnonzero(np.logical_or.reduceat(self.once, np.arange(0, len(self.once), PIECE)))
        once, twice = ([zlib.compress(table[k * PIECE : (k + 1) * PIECE].tobytes(), 1) for k in some] for table in (self.once, self.twice))
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], schema=PIECES)


def merged(a: tuple[bytes, bytes] | None, b: tuple[bytes, bytes] | None) -> tuple[bytes, bytes] | None:
    """The filters of both inputs together; a hash that each has seen once has been seen twice."""
    if a is None or b is None:
        return a or b
    a1, a2, b1, b2 = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (*a, *b))
    return zlib.compress((a1 | b1).tobytes(), 1), zlib.compress((a2 | b2 | (a1 & b1)).tobytes(), 1)


def _array(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), np.uint64).reshape(-1, 2)


def _fill(bits: int, least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen(bits)
        for batch in batches:
            held: list[bytes] = []
            for text in batch.column(0):
                held += _hashed(text.as_py(), least_chars)
            seen.add(_array(held))
        yield seen.pieces()

    return run


def _suspects(filters, bits: int, least_chars: int):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen(8)
        seen.bits, seen.twice = bits, np.frombuffer(zlib.decompress(filters.value), np.uint8)
        for batch in batches:
            held: list[bytes] = []
            owners: list[int] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = _hashed(text.as_py(), least_chars)
                held += own
                owners += [doc] * len(own)
            if held:
                h = _array(held)
                keep = seen.may_repeat(h)
                yield pa.RecordBatch.from_arrays([pa.array(h[keep, 0].view(np.int64)), pa.array(h[keep, 1].view(np.int64)), pa.array(np.array(owners, np.int64)[keep])], schema=schema)

    return run


def _ids(ids: np.ndarray) -> np.ndarray:
    """Rows of two uint64 that stand for ids in a filter."""
    a = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.stack([a ^ (a >> np.uint64(29)), a * np.uint64(0x94D049BB133111EB)], axis=1)


def _fill_ids(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen(bits)
        for batch in batches:
            seen._put(seen.once, _places(_ids(batch.column(0).to_numpy()), bits))
        yield seen.pieces()

    return run


def _affected(filters, bits: int, at: int, names: list[str]):
    """Adds whether a document's id is in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen(8)
        table = np.frombuffer(zlib.decompress(filters.value), np.uint8)
        for batch in batches:
            ids = batch.column(at).cast(pa.int64())
            hit = seen._holds(table, _places(_ids(ids.fill_null(0).to_numpy()), bits)) & ~ids.is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], names=names)

    return run


class Confirmed:
    """Hashes of lines to drop, sorted, with the document that keeps each."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, keeper: np.ndarray):
        order = np.lexsort((h2, h1))
        self.h1, self.h2, self.keeper = h1[order], h2[order], keeper[order]

    def keepers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each hash is there, who keeps its line)."""
        if not len(self.h1):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        a, b = hashes[:, 0].view(np.int64), hashes[:, 1].view(np.int64)
        place = np.searchsorted(self.h1, a)
        inside = lambda p: np.minimum(p, len(self.h1) - 1)
        while (other := (place < len(self.h1)) & (self.h1[inside(place)] == a) & (self.h2[inside(place)] != b)).any():
            place = place + other
        place, there = inside(place), place < len(self.h1)
        return there & (self.h1[place] == a) & (self.h2[place] == b), self.keeper[place]


def _drop(text_at: int, id_at: int, names: list[str], least_chars: int, sent=None, drops_at: int | None = None):
    """Drops lines by the confirmed hashes that were sent, or by those in a column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        confirmed = Confirmed(*sent.value) if sent is not None else None
        for batch in batches:
            texts, lines, dropped = [], [], []
            ids = batch.column(id_at).cast(pa.int64())
            for k, text in enumerate(batch.column(text_at)):
                t = text.as_py()
                own = (t or "").split("\n")
                lines.append(len(own))
                gone: set[int] = set()
                if ids[k].is_valid and (confirmed is not None or batch.column(drops_at)[k].is_valid):
                    places, hashes = [], []
                    for i, x in enumerate(own):
                        if len(x) >= least_chars and len(key := _key(x)) >= least_chars:
                            places.append(i)
                            hashes.append(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower()))
                    if confirmed is not None and places:
                        there, keeper = confirmed.keepers(_array(hashes))
                        gone = {places[j] for j in np.flatnonzero(there & (keeper != ids[k].as_py()))}
                    elif places:
                        out = {int(x["h1"]).to_bytes(8, "little", signed=True) + int(x["h2"]).to_bytes(8, "little", signed=True) for x in batch.column(drops_at)[k].as_py()}
                        gone = {i for i, h in zip(places, hashes, strict=True) if h in out}
                texts.append("\n".join(x for i, x in enumerate(own) if i not in gone) if gone else t)
                dropped.append(len(gone))
            columns = [pa.array(texts, pa.string()) if k == text_at else c for k, c in enumerate(batch.columns) if k != drops_at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=names)

    return run


def _merge_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[bytes, bytes]] = {}
    for batch in batches:
        for k, once, twice in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            held[k] = merged(held.get(k), (once.as_py(), twice.as_py()))
    columns = [*zip(*held.values(), strict=True)] or [(), ()]
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), *(pa.array(x, pa.binary()) for x in columns)], schema=PIECES)


def _merged_filters(parts: DataFrame, bits: int) -> tuple[bytes, bytes]:
    """The filters of all partitions. A piece's rows are merged in one task, so that one pair reaches the driver.

    In mapInArrow, as all else here: functions over an RDD have Python workers of their own, which stay beside the others.
    """
    found = parts.repartition("piece").mapInArrow(given_back(_merge_pieces), parts.schema).toArrow()
    whole = np.zeros((2, bits // 8), np.uint8)
    for k, *pair in zip(*(c.to_pylist() for c in found.columns), strict=True):
        for table, data in zip(whole, pair, strict=True):
            table[k * PIECE : (k + 1) * PIECE] = np.frombuffer(zlib.decompress(data), np.uint8)
    return zlib.compress(whole[0].tobytes(), 1), zlib.compress(whole[1].tobytes(), 1)


def filter_bits(df: DataFrame) -> int:
    """The filter's size for an input, from the size that its plan expects without reading it."""
    expected = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    bits = LEAST_BITS
    while bits < MOST_BITS and bits * BYTES_A_BIT < expected:
        bits *= 2
    return bits


def dedup_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, bits: int | None = None) -> DataFrame:
    """docs with repeated lines dropped from text, and columns n_lines (before) and n_dropped.

    A line's key is the line without ASCII white space at its ends and with A-Z as a-z. A key of ``least_chars`` code points or more
    in ``least_docs`` documents or more loses all its lines but those of the largest doc_id that holds it. Other lines stay, as
    they were. A null or empty text is one empty line and stays as it is.

    Rows that repeat a doc_id are one document for the count and are all treated alike. Rows with a null doc_id aren't counted
    and lose nothing. Other columns pass through; columns that docs has under the two new names are replaced, those
    named as DROPS and DROP_ID too. A very long text is split in one task, by itself. An empty table gives an empty one.
    """
    docs = docs.drop("n_lines", "n_dropped", DROPS, DROP_ID)
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    bits = bits or filter_bits(docs)
    pieces = "piece long, once binary, twice binary"
    twice = context.broadcast(_merged_filters(rows.select("text").mapInArrow(given_back(_fill(bits, least_chars)), pieces), bits)[1])
    suspects = checkpointed(rows.mapInArrow(given_back(_suspects(twice, bits, least_chars)), "h1 long, h2 long, doc_id long"))
    twice.destroy()
    # Checkpointed, the counts are dealt out anew for the join, which adaptive execution can then split at a hot line.
    counted = checkpointed(suspects.distinct().groupBy("h1", "h2").agg(F.count("*").alias("k"), F.max("doc_id").alias("keeper")).where(F.col("k") >= least_docs))
    columns = docs.columns
    names, schema = [*columns, "n_lines", "n_dropped"], StructType([*docs.schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    text_at, id_at = columns.index("text"), columns.index("doc_id")
    if counted.count() <= BROADCAST:
        found = counted.select("h1", "h2", "keeper").toPandas()
        sent = context.broadcast(tuple(found[c].to_numpy(np.int64) for c in ("h1", "h2", "keeper")))
        return docs.mapInArrow(given_back(_drop(text_at, id_at, names, least_chars, sent=sent)), schema)
    drops = suspects.join(counted, ["h1", "h2"]).where("doc_id <> keeper")
    drops = checkpointed(drops.groupBy(F.col("doc_id").alias(DROP_ID)).agg(F.collect_set(F.struct("h1", "h2")).alias(DROPS)))
    id_bits = MOST_BITS if bits > LEAST_BITS else LEAST_BITS
    held = context.broadcast(_merged_filters(drops.select(DROP_ID).mapInArrow(_fill_ids(id_bits), pieces), id_bits)[0])
    flagged = docs.mapInArrow(_affected(held, id_bits, id_at, [*columns, DROPS]), StructType([*docs.schema.fields, StructField(DROPS, BooleanType())]))
    touched = flagged.where(DROPS).drop(DROPS).join(drops, F.col("doc_id").cast("long") == F.col(DROP_ID), "left").drop(DROP_ID)
    rest = flagged.where(f"not {DROPS}").drop(DROPS).withColumn(DROPS, F.lit(None).cast(drops.schema[DROPS].dataType))
    return touched.union(rest).mapInArrow(_drop(text_at, id_at, names, least_chars, drops_at=len(columns)), schema)
