"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly.

A word is the bag of its character n-grams and itself, hashed into a table of vectors; the mean of a window's word
vectors goes into a linear softmax over (clean, toxic), and a document is toxic unless each of its windows is clean. Vectors
and softmax are trained together in numpy, so a misspelling that was never seen shares most n-grams with words that were.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

from transitnet.llm.common import chunks, given_back, training_sample

#: The training sample: documents at most, and characters of each at most.
SAMPLE_DOCS, SAMPLE_CHARS = 4000, 10_000
#: Rows and columns of the table of vectors, and the n-grams' lengths.
BUCKETS, WIDTH, GRAMS = 1 << 19, 8, (3, 4, 5)
#: Words whose vectors are averaged; the longest piece of a word that is hashed at once, and the step to the next.
WINDOW, PIECE, STRIDE = 10, 24, 18
#: Characters of text whose words are looked up together, and distinct words of them that are cut into n-grams at once: some 10 MB of arrays.
STRETCH, TOGETHER = 2_000_000, 5_000
#: A bucket is learnt from if words of so many documents, or more, fall into it; others add nothing.
LEAST_SEEN = 3
#: Steps of the optimizer at least, in whole passes over the sample; documents of a step, and its rate.
STEPS, BATCH, RATE = 128, 250, 0.4

_WORDS = re.compile(r"\w+(?:[^\w\s]\w+)*")


def text_words(text: str | None) -> list[str]:
    """Lower-case runs of word characters, with single marks inside them (w*rd). A word repeated on end counts once."""
    return [w for w, _ in groupby(_WORDS.findall((text or "").lower()))]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every n-gram of every word, and of the word itself."""
    pieces, owner = [], []
    for k, w in enumerate(words):
        if len(w) <= PIECE:
            pieces.append(w)
            owner.append(k)
        else:
            for at in range(0, len(w) - STRIDE // 3, STRIDE):
                pieces.append(w[at : at + PIECE])
                owner.append(k)
    if not pieces:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.array(owner)
    size = np.array([len(p) for p in pieces])
    chars = np.zeros((len(pieces), PIECE + 2), np.uint64)
    chars[:, 1:-1] = np.array(pieces, dtype=f"<U{PIECE}").view(np.uint32).reshape(len(pieces), PIECE)
    chars[:, 0] = 60
    chars[np.arange(len(pieces)), size + 1] = 62
    mix = np.uint64(0x9E3779B97F4A7C15)

    def bucket(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int64)

    found, owners = [], []
    whole = np.full(len(pieces), np.uint64(7))
    for c in range(PIECE + 2):
        whole = np.where(chars[:, c] > 0, (whole + chars[:, c]) * mix, whole)
    found.append(bucket(whole))
    owners.append(owner)
    for n in GRAMS:
        h = np.full((len(pieces), PIECE + 3 - n), np.uint64(n))
        for k in range(n):
            h = (h + chars[:, k : PIECE + 3 - n + k]) * mix
        there = np.arange(PIECE + 3 - n) + n <= (size + 2)[:, None]
        found.append(bucket(h[there]))
        owners.append(np.repeat(owner, there.sum(axis=1)))
    found, owners = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return found[order], owners[order]


def _windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, document) of the windows of documents with so many words; the last is filled up from before."""
    each = np.maximum(1, -(-counts // WINDOW)) * (counts > 0)
    doc = np.repeat(np.arange(len(counts)), each)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
    start = np.minimum(number * WINDOW, np.maximum(counts[doc] - WINDOW, 0))
    return start + np.repeat(np.cumsum(counts) - counts, each), doc


class Model:
    """gains: what a bucket adds to the difference of the two logits; bias: that difference without words."""

    def __init__(self, gains: np.ndarray | None = None, bias: float = 0.0):
        self.gains, self.bias = np.zeros(BUCKETS, np.float32) if gains is None else gains, bias

    def words(self, words: list[str]) -> np.ndarray:
        """The mean gain of each word's subwords: what its vector adds by the linear softmax."""
        means = [np.zeros(0)]
        for at in range(0, len(words), TOGETHER):
            found, owner = subwords(own := words[at : at + TOGETHER])
            gain = self.gains[found]
            means.append(np.bincount(owner, gain, len(own)) / np.maximum(np.bincount(owner[gain != 0], minlength=len(own)), 1))
        return np.concatenate(means)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        known: dict[str, int] = {}
        ids, counts = [], []
        for t in texts:
            own = text_words(t)
            ids += [known.setdefault(w, len(known)) for w in own]
            counts.append(len(own))
        counts = np.array(counts)
        gain = self.words(list(known))[np.array(ids, np.int64)] if ids else np.zeros(0)
        total = np.concatenate([[0.0], np.cumsum(gain)])
        start, doc = _windows(counts)
        size = np.minimum(counts[doc], WINDOW)
        z = self.bias + (total[start + size] - total[start]) / np.maximum(size, 1)
        clean = np.bincount(doc, -np.logaddexp(0.0, z), len(texts))
        clean = np.where(counts > 0, clean, -np.logaddexp(0.0, self.bias))
        return -np.expm1(clean)


def fit(rows: list[tuple[str, int]]) -> Model:
    """Adagrad on the log-likelihood of the documents' labels, by batches of documents; the table of vectors and the softmax move together."""
    known: dict[str, int] = {}
    docs = [np.array([known.setdefault(w, len(known)) for w in text_words(text)], np.int32) for text, _ in rows]
    y = np.array([int(label > 0) for _, label in rows])
    use = np.array([len(d) > 0 for d in docs])
    words, parts = list(known), []
    for at in range(0, len(words), 50_000):
        found, owner = subwords(words[at : at + 50_000])
        parts.append((found.astype(np.int32), (owner + at).astype(np.int32)))
    sub, owner = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (list(z) for z in zip(*parts, strict=True))) if parts else (np.zeros(0, np.int32),) * 2
    spread = np.bincount(np.concatenate([np.unique(d) for d in docs]) if docs else np.zeros(0, np.int32), minlength=len(words))
    seen = np.bincount(sub, spread[owner], BUCKETS)
    sub, owner = sub[seen[sub] >= LEAST_SEEN], owner[seen[sub] >= LEAST_SEEN]
    many = np.bincount(owner, minlength=len(words))
    first = np.cumsum(many) - many
    rng = np.random.default_rng(7)
    table = (rng.standard_normal((BUCKETS, WIDTH)) / 100).astype(np.float32)
    soft = np.zeros((WIDTH, 2), np.float32)
    soft[:, 1] = 1.0 / np.sqrt(WIDTH)
    bias = np.array([2.0, -2.0], np.float32)
    seen_table, seen_soft, seen_bias = np.full(BUCKETS, 1e-10, np.float32), np.full((WIDTH, 2), 1e-8), np.full(2, 1e-8)
    weight = np.where(y == 1, 0.5 / max(1, (y & use).sum()), 0.5 / max(1, ((1 - y) & use).sum())) * use
    for _ in range(-(-STEPS // max(1, -(-int(use.sum()) // BATCH)))):
        order = rng.permutation(np.flatnonzero(use))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            counts = np.array([len(docs[k]) for k in batch])
            own, ids = np.unique(np.concatenate([docs[k] for k in batch]), return_inverse=True)
            n = many[own]
            until = np.cumsum(n)
            place = np.repeat(first[own] - until + n, n) + np.arange(until[-1])
            b_sub, b_owner, size_w = sub[place], np.repeat(np.arange(len(own)), n), np.maximum(n, 1).astype(np.float32)
            vectors = np.stack([np.bincount(b_owner, table[b_sub, c], len(own)) for c in range(WIDTH)], axis=1).astype(np.float32) / size_w[:, None]
            start, doc = _windows(counts)
            size = np.minimum(counts[doc], WINDOW)
            slot = np.minimum(start[:, None] + np.arange(WINDOW), len(ids) - 1)
            part = np.arange(WINDOW) < size[:, None]
            word = ids[slot]
            bags = np.einsum("wks,wk->ws", vectors[word], part.astype(np.float32)) / size[:, None]
            logits = bags @ soft + bias
            z = logits[:, 1] - logits[:, 0]
            clean = np.bincount(doc, -np.logaddexp(0.0, z), len(batch))
            toxic = np.maximum(-np.expm1(clean), 1e-9)
            # d log p / d z of each window: -sigma for a clean document, sigma * P(clean) / P(toxic) for a toxic one.
            sigma = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            g = (sigma * np.where(y[batch][doc] == 1, (np.exp(clean) / toxic)[doc], -1.0) * weight[batch][doc]).astype(np.float32)
            pull = np.stack([-g, g], axis=1)
            d_soft, d_bias = bags.T @ pull, pull.sum(axis=0)
            flat = np.repeat((pull @ soft.T) / size[:, None], size, axis=0)
            inside = word[part]
            d_word = np.stack([np.bincount(inside, flat[:, c], len(own)) for c in range(WIDTH)], axis=1) / size_w[:, None]
            hit, b_sub = np.unique(b_sub, return_inverse=True)
            d_hit = np.stack([np.bincount(b_sub, d_word[b_owner, c], len(hit)) for c in range(WIDTH)], axis=1).astype(np.float32)
            seen_table[hit] += (d_hit**2).mean(axis=1)
            seen_soft += d_soft**2
            seen_bias += d_bias**2
            table[hit] += RATE * d_hit / np.sqrt(seen_table[hit])[:, None]
            soft += (RATE * d_soft / np.sqrt(seen_soft)).astype(np.float32)
            bias += (RATE * d_bias / np.sqrt(seen_bias)).astype(np.float32)
    gains = np.where(seen >= LEAST_SEEN, table @ (soft[:, 1] - soft[:, 0]), 0)
    return Model(gains.astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic") -> Model:
    """A model fitted to at most SAMPLE_DOCS of the labelled documents that ``usable`` allows.

    Without documents of both labels there is nothing to learn, and every text scores 0.
    """
    rows = training_sample(docs, labels, label, usable, SAMPLE_DOCS, SAMPLE_CHARS)
    return fit(rows) if len({y > 0 for _, y in rows}) == 2 else Model(bias=-50.0)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with the column ``name``: each text's probability to be toxic, from 0 to 1. A null or empty text has no words.

    Every row is scored by itself, all its windows however long it is, so repeated rows get equal scores. Other columns pass through;
    one of that name is replaced. An empty table gives an empty one.
    """
    docs = docs.drop(name)
    at, names = docs.columns.index("text"), [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[np.ndarray] = [np.zeros(0)]
            for part in chunks(((t.as_py(),) for t in batch.column(at)), lambda t: len(t[0] or ""), STRETCH):
                out.append(model.scores([t for (t,) in part]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out), pa.float64())], names=names)

    return docs.mapInArrow(given_back(run), StructType([*docs.schema.fields, StructField(name, DoubleType())]))
