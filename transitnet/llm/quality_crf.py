"""Quality classifier: a linear-chain conditional random field over a document's lines.

Each line gets features of itself and of the lines beside it. The field labels every line good or bad; the
forward-backward algorithm gives each line's probability to be good, and their mean, weighted by the lines' lengths,
is the document's quality. Trained in numpy on a bounded sample of labelled documents, all of whose lines carry
the document's label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from transitnet.llm.common import WORD, chunks, training_sample

#: The training sample: documents at most, and characters of each at most.
SAMPLE_DOCS, SAMPLE_CHARS = 3000, 20_000
#: Lines, padding included, of documents that are worked on together.
LINES = 65_536
#: Steps of the optimizer, its rate, and the weight of the penalty on the parameters' squares.
STEPS, RATE, PENALTY = 200, 0.08, 1e-3

_WORDS = re.compile(WORD)
_MARK = re.compile(r"[#*$%&|<>]")
#: Features of a line alone, the first of them a constant.
OWN = 12


def line_features(line: str) -> list[float]:
    """Shares of marked, upper-case, repeated and one-sided words, and coarse lengths; all between 0 and 1."""
    words = _WORDS.findall(line)
    n = len(words)
    if not n:
        return [1.0] + [0.0] * (OWN - 2) + [1.0]
    distinct = len(set(words)) / n
    again = sum(map(str.__eq__, words, words[1:])) / max(1, n - 1)
    upper = sum(map(str.isupper, words)) / n
    joined = "".join(words)
    marked = min(1.0, len(_MARK.findall(joined)) / n)
    letters = sum(map(str.isalpha, words)) / n
    return [
        1.0, marked, upper, again, 1 - distinct if n >= 8 else 0.0, 1.0 - letters, min(1.0, line.count("|") / n), min(1.0, line.count("!") / n),
        min(1.0, len(joined) / n / 20), min(1.0, n / 100), 1.0 if n < 4 else 0.0, 0.0,
    ]


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, lengths) of a text's lines; the features of the lines before and behind follow a line's own."""
    lines = (text or "").split("\n")
    memo: dict[str, list[float]] = {}
    own = np.array([memo[x] if x in memo else memo.setdefault(x, line_features(x)) for x in lines], np.float32)
    edge = np.zeros((1, OWN), np.float32)
    padded = np.concatenate([edge, own, edge])
    return np.concatenate([own, padded[:-2], padded[2:]], axis=1), np.array([len(x) + 1 for x in lines], float)


class Chain:
    """Two states (bad, good) with emission weights for their difference, and a start and transition table."""

    def __init__(self, width: int):
        self.w = np.zeros(width)
        self.move = np.zeros((2, 2))
        self.start = np.zeros(2)

    def _passes(self, score: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log forward and backward messages (docs, lines, 2) of padded scores for "good"."""
        docs, most = score.shape
        emit = np.stack([np.zeros_like(score), score], axis=2)
        ahead, back = np.zeros((docs, most, 2)), np.zeros((docs, most, 2))
        ahead[:, 0] = self.start + emit[:, 0]
        for t in range(1, most):
            ahead[:, t] = np.logaddexp(ahead[:, t - 1, 0, None] + self.move[0], ahead[:, t - 1, 1, None] + self.move[1]) + emit[:, t]
        for t in range(most - 2, -1, -1):
            later = back[:, t + 1] + emit[:, t + 1]
            step = np.logaddexp(self.move[:, 0] + later[:, 0, None], self.move[:, 1] + later[:, 1, None])
            back[:, t] = np.where((t + 1 < lengths)[:, None], step, 0.0)
        return ahead, back

    def marginals(self, score: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each line's probability to be good."""
        ahead, back = self._passes(score, lengths)
        both = ahead + back
        return 1 / (1 + np.exp(np.clip(both[..., 0] - both[..., 1], -60, 60)))

    def fit(self, docs: list[tuple[np.ndarray, int]]) -> Chain:
        """docs: features of all lines and the label that they share. Full-batch Adam on the mean log-likelihood."""
        docs = sorted(docs, key=lambda d: len(d[0]))
        groups: list[list[tuple[np.ndarray, int]]] = []
        for d in docs:
            # Documents of like length are padded together, to a bounded number of lines: those of very many lines by themselves.
            if groups and len(groups[-1]) < 256 and (len(groups[-1]) + 1) * len(d[0]) <= LINES:
                groups[-1].append(d)
            else:
                groups.append([d])
        packed = []
        for g in groups:
            lengths = np.array([len(x) for x, _ in g])
            x = np.zeros((len(g), lengths.max(), len(self.w)), np.float32)
            for k, (own, _) in enumerate(g):
                x[k, : len(own)] = own
            packed.append((x, lengths, np.array([y for _, y in g]), np.arange(lengths.max()) < lengths[:, None]))
        share = [np.mean([y == c for _, y in docs]) for c in (0, 1)]
        theta = np.concatenate([self.w, self.move.ravel(), self.start])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, STEPS + 1):
            self.w, self.move, self.start = theta[: len(self.w)], theta[len(self.w) : -2].reshape(2, 2), theta[-2:]
            grad = np.zeros_like(theta)
            for x, lengths, y, real in packed:
                score = x @ self.w
                ahead, back = self._passes(score, lengths)
                last = ahead[np.arange(len(y)), lengths - 1]
                norm = np.logaddexp(last[:, 0], last[:, 1])[:, None]
                p = np.exp(np.minimum(ahead + back - norm[..., None], 0)) * real[..., None]  # what pads a document may exceed its sum
                weight = 0.5 / np.where(y == 1, share[1], share[0]) / lengths  # classes and documents count alike
                off = (real * (y[:, None] - p[..., 1])) * weight[:, None]
                grad[: len(self.w)] += np.einsum("dl,dlf->f", off, x)
                if x.shape[1] > 1:
                    emit = np.stack([np.zeros_like(score), score], axis=2)
                    inner = ahead[:, :-1, :, None] + self.move + (emit + back)[:, 1:, None, :] - norm[..., None, None]
                    pair = np.exp(np.minimum(inner, 0)) * real[:, 1:, None, None]
                    seen = np.zeros_like(pair)
                    seen[np.arange(len(y)), :, y, y] = real[:, 1:]
                    grad[len(self.w) : -2] += np.einsum("dlab,d->ab", seen - pair, weight).ravel()
                grad[-2:] += ((np.eye(2)[y] - p[:, 0]) * weight[:, None]).sum(axis=0)
            grad = grad / len(docs) - PENALTY * theta
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.w, self.move, self.start = theta[: len(self.w)], theta[len(self.w) : -2].reshape(2, 2), theta[-2:]
        return self

    def qualities(self, texts: list[str | None]) -> list[float]:
        """The length-weighted mean of the lines' probabilities, for each text."""
        done = [text_features(t) for t in texts]
        out = [0.0] * len(texts)
        order = sorted(range(len(texts)), key=lambda k: len(done[k][1]))
        for run in chunks(((k,) for k in order), lambda k: len(done[k[0]][1]), 4000):
            own = [k for (k,) in run]
            lengths = np.array([len(done[k][1]) for k in own])
            score = np.zeros((len(own), lengths.max()))
            for i, k in enumerate(own):
                score[i, : lengths[i]] = done[k][0] @ self.w
            p = self.marginals(score, lengths)
            for i, k in enumerate(own):
                out[k] = float(np.average(p[i, : lengths[i]], weights=done[k][1]))
        return out


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality") -> Chain:
    """A chain fitted to at most SAMPLE_DOCS of the labelled documents that ``usable`` allows.

    Without documents of both labels there is nothing to learn, and every line is as likely good as bad.
    """
    rows = training_sample(docs, labels, label, usable, SAMPLE_DOCS, SAMPLE_CHARS)
    chain = Chain(3 * OWN)
    return chain.fit([(text_features(t)[0], int(y > 0)) for t, y in rows]) if len({y > 0 for _, y in rows}) == 2 else chain


def score(docs: DataFrame, chain: Chain, name: str = "score") -> DataFrame:
    """docs with the column ``name``: each text's quality, from 0 to 1. A null or empty text is one empty line.

    Every row is scored by itself, whole, however many lines it has; repeated rows get equal scores. Other columns pass through;
    one of that name is replaced. An empty table gives an empty one.
    """
    docs = docs.drop(name)
    at, names = docs.columns.index("text"), [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[float] = []
            for part in chunks(((t,) for t in batch.column(at).to_pylist()), lambda t: len(t[0] or ""), 4_000_000):
                out += chain.qualities([t for (t,) in part])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def held_out(folds: int, fold: int) -> Column:
    """Whether a doc_id's crc32 falls into the fold that isn't learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))
