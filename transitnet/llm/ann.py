"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the graph of nearest neighbours is cut into equal parts with few edges between them, and a small classifier
learns from a vector which parts its neighbours lie in. Every vector is then indexed under its most probable part. A query goes
to its several most probable parts, whose vectors are ranked exactly. How many parts it takes is measured on vectors that
the classifier hasn't seen. Parts that are still large are cut again in the same way, each by a classifier of its own that is
trained where the part's sample is, so that the vectors of a part, and so the work for a query, stay bounded.

Equal vectors are indexed once, with the ids that can appear in a result. The vectors of a part are packed into blocks of bounded
size, and so are its queries; a block of vectors meets the blocks of queries that are routed to its part, a bounded number of them
in a task, and hands on the best of each query.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transitnet.llm.common import checkpointed

#: Vectors of a sample that parts are learnt from, and of it for each part at least; neighbours of each in the graph; hidden units of the classifier.
SAMPLE, LEAST_SAMPLE, NEIGHBOURS, HIDDEN = 6000, 48, 10, 96
#: Vectors that a part is meant to have, and the fewest parts of a level; vectors and queries of a block; blocks of queries that a task holds against a block of vectors.
PART, FEWEST, BLOCK, TOGETHER = 2000, 8, 2048, 16
#: Neighbours of unseen vectors of the sample that the parts taken at all levels must hold.
RECALL = 0.94
#: Pairs whose products are summed at once; rows that a task holds to hand on only the best of each query that it met in several blocks.
PAIRS, HELD = 50_000, 500_000


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """(len(x), k) numbers of the largest inner products."""
    out = []
    for at in range(0, len(x), 1024):
        g = x[at : at + 1024] @ x.T
        g[np.arange(len(g)), at + np.arange(len(g))] = -np.inf
        out.append(np.argpartition(-g, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def _halves(own: np.ndarray, graph: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether each of ``own`` goes right: a balanced cut of the graph, improved by swaps of the worst placed."""
    local = np.full(len(graph), -1)
    local[own] = np.arange(len(own))
    a = np.repeat(np.arange(len(own)), graph.shape[1])
    b = local[graph[own].ravel()]
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.bincount(a, minlength=len(own))
    v = (x[own] - x[own].mean(axis=0)) @ np.linalg.svd(x[own] - x[own].mean(axis=0), full_matrices=False)[2][0]
    for _ in range(30):  # towards the slowest walk on the graph
        v = 0.5 * v + 0.5 * np.bincount(a, v[b], len(own)) / np.maximum(degree, 1)
        v = v - v.mean()
        v = v / (np.linalg.norm(v) + 1e-12)
    right = np.zeros(len(own), bool)
    right[np.argsort(v, kind="stable")[len(own) // 2 :]] = True
    for _ in range(20):
        over = np.bincount(a, right[b] != right[a], len(own))
        gain = 2 * over - degree
        l, r = (np.flatnonzero(right == side) for side in (False, True))
        l, r = l[np.argsort(-gain[l], kind="stable")], r[np.argsort(-gain[r], kind="stable")]
        m = min(len(l), len(r), max(1, len(own) // 50))
        good = gain[l[:m]] + gain[r[:m]] > 0
        if not good.any():
            break
        right[l[:m][good]], right[r[:m][good]] = True, False
    return right


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """A part number for each vector; parts is a power of two, and parts differ by one vector at most for each halving."""
    number = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        halves = []
        for own in groups:
            right = _halves(own, graph, x) if len(own) > 2 else np.arange(len(own)) >= len(own) // 2
            halves += [own[~right], own[right]]
        groups = halves
    for k, own in enumerate(groups):
        number[own] = k
    return number


class Router:
    """One hidden layer and a softmax over parts."""

    def __init__(self, x: np.ndarray, wanted: np.ndarray, epochs: int = 25):
        """wanted: (len(x), parts), the share of a vector's neighbours (itself included) in each part."""
        rng = np.random.default_rng(3)
        d, parts = x.shape[1], wanted.shape[1]
        p = [rng.standard_normal((d, HIDDEN)) * np.sqrt(2 / d) * 2, np.zeros(HIDDEN), rng.standard_normal((HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts)]
        m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 256):
                rows = order[at : at + 256]
                h = np.maximum(x[rows] @ p[0] + p[1], 0)
                z = h @ p[2] + p[3]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                off = (z / z.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
                back = (off @ p[2].T) * (h > 0)
                step += 1
                for k, g in enumerate((x[rows].T @ back, back.sum(axis=0), h.T @ off, off.sum(axis=0))):
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - 3e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.p = p

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Logits of the parts."""
        return np.maximum(x @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3]


def learn(x: np.ndarray, parts: int, recall: float, k: int = 20) -> tuple[Router, int]:
    """(router, parts that a query takes) from a sample, whose every tenth vector only asks.

    The parts taken hold ``recall`` of the k nearest of those that ask, under the parts that the router indexes.
    """
    asks = np.arange(len(x)) % 10 == 9
    scale = np.linalg.norm(x, axis=1).mean()
    asked, unit = x[asks] / scale, x[~asks] / scale
    graph = neighbour_graph(unit, min(NEIGHBOURS, len(unit) - 1))
    part = balanced_parts(unit, graph, parts)
    wanted = np.full((len(unit), parts), 0.0)
    np.add.at(wanted, (np.repeat(np.arange(len(unit)), graph.shape[1]), part[graph].ravel()), 1.0)
    wanted[np.arange(len(unit)), part] += 2.0
    router = Router(unit, wanted / wanted.sum(axis=1, keepdims=True))
    own = router(unit).argmax(axis=1)
    order = np.argsort(-router(asked), axis=1)
    near = np.argsort(-(asked @ unit.T), axis=1)[:, :k]
    router.p[0] = router.p[0] / scale
    for take in range(1, parts + 1):
        if (order[:, None, :take] == own[near][:, :, None]).any(axis=2).mean() >= recall:
            break
    return router, take


def parts_for(count: int, sample: int) -> int:
    """How many parts a level has: a power of two, for PART vectors each, as far as the sample tells them apart."""
    parts = FEWEST
    while parts * PART < count and 2 * parts * LEAST_SAMPLE <= sample:
        parts *= 2
    return parts


class Routes:
    """The levels of parts: a router for all vectors, and one for each of its parts that is cut again.

    A part's number is that of the first level times 2^20, plus that of the second.
    """

    def __init__(self, first: tuple[Router, int] | None, second: dict[int, tuple[Router, int]] | None = None):
        self.first, self.second = first, second or {}

    def __call__(self, x: np.ndarray, queries: bool) -> tuple[np.ndarray, np.ndarray]:
        """(row, part) of the part that each vector is indexed under, or of those that a query goes to."""
        if self.first is None:
            return np.arange(len(x)), np.zeros(len(x), np.int64)
        router, take = self.first
        order = np.argsort(-router(x), axis=1, kind="stable")[:, : take if queries else 1]
        row, part = np.repeat(np.arange(len(x)), order.shape[1]), order.ravel()
        out = []
        for p in np.unique(part).tolist():
            own = row[part == p]
            if p in self.second:
                router, take = self.second[p]
                order = np.argsort(-router(x[own]), axis=1, kind="stable")[:, : take if queries else 1]
                out.append((np.repeat(own, order.shape[1]), (p << 20) + order.ravel()))
            else:
                out.append((own, np.full(len(own), p << 20)))
        return np.concatenate([r for r, _ in out]), np.concatenate([p for _, p in out])


def _routed(df: DataFrame, routes: Routes, queries: bool) -> DataFrame:
    """(own, v) by part: rows (own, v as bytes, part), one for each part of the vector."""
    kind, wide = df.schema[0].dataType.simpleString(), df.schema[1].dataType.elementType.simpleString() == "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            row, part = routes(x.astype(float), queries)
            packed = pa.array([r.astype(np.float64 if wide else np.float32).tobytes() for r in x], pa.binary())
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), packed.take(row), pa.array(part, pa.int64())], names=["own", "v", "part"])

    return df.mapInArrow(run, f"own {kind}, v binary, part long")


def best(ids: np.ndarray, q: np.ndarray, lists: list, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vec_id, score): the k nearest of each query among vectors with their ids, ties to the smaller id.

    All vectors that come within a rounding error of the (k + 1)-th best are summed exactly as pairs, however many tie there.
    """
    many = np.array([len(own) for own in lists])
    flat, first = np.concatenate([np.asarray(own, np.int64) for own in lists]), np.cumsum(many) - many
    slack = 1e-13 * q.shape[1] * np.linalg.norm(v, axis=1).max()
    m, out = min(k + 1, len(v)), []
    for at in range(0, len(q), 256):
        g = q[at : at + 256] @ v.T
        least = np.partition(g, len(v) - m, axis=1)[:, len(v) - m] - slack * np.linalg.norm(q[at : at + 256], axis=1)
        row, col = np.nonzero(g >= least[:, None])
        row += at
        score = np.concatenate([(q[row[b : b + PAIRS]] * v[col[b : b + PAIRS]]).sum(axis=1) for b in range(0, len(row), PAIRS)])
        each = many[col]
        until = np.cumsum(each)
        own = flat[np.repeat(first[col] - until + each, each) + np.arange(until[-1])]
        row, score = np.repeat(row, each), np.repeat(score, each)
        other = own != ids[row]
        row, score, own = row[other], score[other], own[other]
        order = np.lexsort((own, -score, row))
        row, score, own = row[order], score[order], own[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        out.append((ids[row[keep]], own[keep], score[keep]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def merged(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each query; a vec_id that stands several times counts by its best."""
    order = np.lexsort((-score, vec, query))
    query, vec, score = query[order], vec[order], score[order]
    once = np.ones(len(query), bool)
    once[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
    query, vec, score = query[once], vec[once], score[once]
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[keep], vec[keep], score[keep]


def _meet(k: int, width: int):
    """Over rows sorted by block of vectors, the vectors before the queries: the k nearest of each query in the task's blocks."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    numbers = lambda packed: np.frombuffer(packed.as_buffer(), np.float32 if width == 4 else np.float64).astype(float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, v, held = [], None, []
        together = lambda: merged(*(np.concatenate(c) for c in zip(*held, strict=True)), k)
        packed = lambda found: pa.RecordBatch.from_arrays([pa.array(c) for c in found], schema=schema)
        for batch in batches:
            ids, owners, vs = (batch.column(batch.schema.get_field_index(c)) for c in ("ids", "lists", "vs"))
            for row in range(batch.num_rows):
                if owners[row].is_valid:
                    lists = owners[row].as_py()
                    v = numbers(vs[row]).reshape(len(lists), -1)
                    continue
                own = np.frombuffer(ids[row].as_buffer(), np.int64)
                held.append(best(own, numbers(vs[row]).reshape(len(own), -1), lists, v, k))
                if sum(len(x[0]) for x in held) > HELD:
                    held = [together()]
                    if len(held[0][0]) > HELD // 2:  # many queries rather than many blocks of the same ones
                        yield packed(held.pop())
        if held:
            yield packed(together())

    return run


def _one_of_each(rows: DataFrame, count: int, k: int) -> DataFrame:
    """(ids, v): each vector with its k + 1 smallest ids, which alone can be in a result. Kept by rounds of bounded groups, from hashed shares to the whole."""
    shares = 1
    while shares * 4096 < count:
        shares *= 64
    ids = rows.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(shares)).alias("share")).agg(F.collect_set("vec_id").alias("ids"))
    least = lambda ids: F.slice(F.array_sort(F.array_distinct(ids)), 1, k + 1)
    ids = ids.select("v", "share", least(F.col("ids")).alias("ids"))
    while shares > 1:
        shares //= 64
        ids = ids.groupBy("v", F.pmod("share", F.lit(shares)).alias("share")).agg(least(F.flatten(F.collect_list("ids"))).alias("ids"))
    return checkpointed(ids.select("ids", "v"))


def learnt(ids: DataFrame, k: int) -> Routes:
    """The routes of distinct vectors (ids, v), from a sample of at most SAMPLE of all, and of each part that is cut again."""
    hashed = F.xxhash64(F.element_at("ids", 1))
    sample = ids.select(hashed.alias("h"), "ids", "v").orderBy("h", "ids").limit(SAMPLE).select("v").toPandas()["v"]
    x = np.stack([np.asarray(s, float) for s in sample])
    if len(x) < 10 * FEWEST:
        return Routes(None)
    count = ids.count()
    parts = parts_for(count, len(x))
    if parts * 2 * PART >= count or parts * 2 * LEAST_SAMPLE <= SAMPLE:
        return Routes(learn(x, parts, RECALL, k))
    level = RECALL**0.5
    first = learn(x, parts, level, k)
    indexed = _routed(ids.select(hashed.alias("h"), "v"), Routes(first), False).withColumn("part", F.shiftright("part", 20))
    sizes = indexed.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > 2 * PART)
    share = (F.shiftrightunsigned(F.xxhash64("own"), 11) / float(1 << 53)) * F.col("n") < 1.2 * SAMPLE
    wide = ids.schema["v"].dataType.elementType.simpleString() == "double"

    def train(key, pdf: pd.DataFrame) -> pd.DataFrame:
        own = np.stack([np.frombuffer(v, np.float64 if wide else np.float32).astype(float) for v in pdf.sort_values("own")["v"].iloc[:SAMPLE]])
        made = learn(own, parts_for(int(pdf["n"].iloc[0]), len(own)), level, k) if len(own) >= 10 * FEWEST else None
        return pd.DataFrame({"part": [key[0]], "made": [pickle.dumps(made)]})

    made = indexed.join(sizes, "part").where(share).groupBy("part").applyInPandas(train, "part long, made binary").collect()
    return Routes(first, {r["part"]: m for r in made if (m := pickle.loads(bytes(r["made"])))})


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): of each vec_id divisible by ``every``, the k nearest others that are found.

    Nearness is the inner product in double precision, of floats or doubles as they are; ties go to the smaller vec_id, however
    many tie. Rows whose vec_id or vector is null, whose vector is empty, zero or holds a null or non-finite component take no
    part; nor do vectors of another length than most, which have no inner product with them. A query leaves out all rows of its own vec_id; an id with several
    vectors asks with each, and is found by its best. Other columns are ignored. An empty table gives no rows; fewer candidates
    than k give fewer rows.
    """
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    kind = "float" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "double"
    rows = vectors.where(v.isNotNull() & F.col("vec_id").isNotNull()).where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.cast(f"array<{kind}>").alias("v"))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    rows = rows.where(F.size("v") == lengths["d"])
    ids = _one_of_each(rows, lengths["n"], k)
    routes = learnt(ids, k)

    def blocks(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """df with the block of its part that each row is dealt to by hash, so that none is much larger than BLOCK; and the blocks of each part."""
        many = df.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
        return df.join(many, "part").withColumn("block", F.pmod(F.xxhash64("v", "own"), F.col("blocks"))).drop("blocks"), many

    def pack_queries(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "asking": [key[1]], "ids": [np.array(pdf["own"], np.int64).tobytes()], "vs": [b"".join(pdf["v"])]})

    def pack_vectors(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "block": [key[1]], "lists": [[list(map(int, o)) for o in pdf["own"]]], "vs": [b"".join(pdf["v"])]})

    indexed, held = blocks(_routed(ids, routes, False))
    indexed = indexed.groupBy("part", "block").applyInPandas(pack_vectors, "part long, block long, lists array<array<bigint>>, vs binary")
    asked, asking = blocks(_routed(rows.where(F.col("vec_id") % every == 0).distinct(), routes, True))
    asked = asked.groupBy("part", "block").applyInPandas(pack_queries, "part long, asking long, ids binary, vs binary")
    # A block of vectors and TOGETHER blocks of queries of its part are a unit of work: vectors go to each such group, queries to each block.
    none = lambda kind: F.lit(None).cast(kind)
    upto = lambda last: F.explode(F.sequence(F.lit(0).cast("long"), last))
    targets = indexed.join(asking, "part").select("part", "block", upto(F.floor((F.col("blocks") - 1) / TOGETHER)).alias("team"), F.lit(-1).cast("long").alias("asking"), none("binary").alias("ids"), "lists", "vs")
    queries = asked.join(held, "part").select("part", upto(F.col("blocks") - 1).alias("block"), F.floor(F.col("asking") / TOGETHER).alias("team"), "asking", "ids", none("array<array<bigint>>").alias("lists"), "vs")
    work = targets.union(queries).repartition("part", "block", "team").sortWithinPartitions("part", "block", "team", "asking")
    found = work.mapInArrow(_meet(k, 4 if kind == "float" else 8), "query_id long, vec_id long, score double")
    found = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
