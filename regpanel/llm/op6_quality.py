"""Quality classifier: random-indexing word vectors pooled per document, then
a two-layer numpy network whose probabilities are calibrated by a temperature.

Random indexing: every token has a sparse ternary *index vector* derived from
a hash of the token; the *context vector* of a token is the sum of the index
vectors of its neighbours over the training texts. Tokens are hashed into a
fixed number of rows, so the model has a fixed size and an unseen token still
has a vector (its own index vector). A document is pooled into the mean and the spread of its
token vectors and the mean agreement (inner product) of the vectors of tokens one and two places apart, which
tells repetition and disorder. Nothing but these vectors is an input. The network (one hidden tanh layer)
is fitted with Adam on the driver over a bounded sample of labelled rows
(``SAMPLE_PER_CLASS`` a class, not counting the held-out rows); a fold of that sample sets the temperature.

Scoring runs in ``mapInPandas`` without a shuffle; the model (about 2 MB) is
broadcast. Whole texts are read; a text longer than ``CHUNK_TOKENS`` tokens is
pooled chunk by chunk, so memory stays bounded.

Defined results: a null text counts as empty; an empty text is scored from
its (zero) features like any other; repeated rows are scored alike, one output
row per input row; an empty table gives an empty result; without labels of
both classes every score is 0.5 (predicted 1). Only the key and the text are
read, so extra columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, labelled_sample

#: Labelled rows per class that the classifier is fitted on (a bound on the driver's work).
SAMPLE_PER_CLASS = 1500
FOLDS, HELD_FOLD = 3, 1
ROWS, DIM, NONZERO = 1 << 14, 32, 4
WINDOW = 2
LAGS = (1, 2)
HIDDEN = 24
CHUNK_TOKENS = 50_000
CACHE_CHUNKS = 200_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


class RowCache(dict):
    """White-space delimited chunk of a text -> the vector rows of its tokens."""

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        rows = tuple(zlib.crc32(t.encode("utf-8", "surrogatepass")) % ROWS for t in TOKEN.findall(chunk))
        self[chunk] = rows
        return rows


def token_rows(text: str, cache: RowCache) -> np.ndarray:
    """The vector row of every token of a text, in order."""
    return np.fromiter(chain.from_iterable(map(cache.__getitem__, text.lower().split())), dtype=np.int32)


def index_vectors(seed: int = 5) -> np.ndarray:
    """Sparse ternary index vectors, one a row."""
    rng = np.random.default_rng(seed)
    out = np.zeros((ROWS, DIM), dtype=np.float32)
    at = np.argsort(rng.random((ROWS, DIM)), axis=1)[:, :NONZERO]
    sign = rng.choice(np.array([-1.0, 1.0], dtype=np.float32), size=(ROWS, NONZERO))
    np.put_along_axis(out, at, sign, axis=1)
    return out


def context_vectors(texts: list[np.ndarray], index: np.ndarray) -> np.ndarray:
    """Token vectors: own index vector plus the mean of the neighbours', unit length."""
    total = np.zeros_like(index)
    seen = np.zeros(ROWS, dtype=np.float32)
    for rows in texts:
        for start in range(0, len(rows), CHUNK_TOKENS):
            r = rows[start:start + CHUNK_TOKENS + WINDOW]
            for lag in range(1, WINDOW + 1):
                np.add.at(total, r[lag:], index[r[:-lag]])
                np.add.at(total, r[:-lag], index[r[lag:]])
        seen += np.bincount(rows, minlength=ROWS)
    total /= np.maximum(seen, 1.0)[:, None]
    total += index
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.maximum(norm, 1e-9)).astype(np.float32)


def pooled(text: str, vectors: np.ndarray, cache: RowCache) -> np.ndarray:
    """Features of one whole text."""
    rows = token_rows(text, cache)
    n = len(rows)
    out = np.zeros(2 * DIM + len(LAGS), dtype=np.float64)
    if not n:
        return out
    total, squares, agree = np.zeros(DIM), np.zeros(DIM), np.zeros(len(LAGS))
    for start in range(0, n, CHUNK_TOKENS):
        v = vectors[rows[start:start + CHUNK_TOKENS + max(LAGS)]]
        total += v[:CHUNK_TOKENS].sum(axis=0, dtype=np.float64)
        squares += np.square(v[:CHUNK_TOKENS]).sum(axis=0, dtype=np.float64)
        for i, lag in enumerate(LAGS):
            agree[i] += float(np.einsum("ij,ij->", v[:-lag], v[lag:])) if len(v) > lag else 0.0
    out[:DIM] = total / n
    out[DIM:DIM + len(LAGS)] = agree / n
    out[DIM + len(LAGS):] = np.sqrt(np.maximum(squares / n - out[:DIM] ** 2, 0.0))
    return out


@dataclass
class Quality:
    """A fitted model; ``w1 is None`` means that nothing could be learnt."""
    vectors: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    w1: np.ndarray | None = None
    b1: np.ndarray | None = None
    w2: np.ndarray | None = None
    b2: float = 0.0
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, texts: list[str], cache: RowCache) -> np.ndarray:
        if self.w1 is None or not texts:
            return np.full(len(texts), 0.5)
        x = np.array([pooled(t, self.vectors, cache) for t in texts])
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(sample: list[tuple[str, int]], epochs: int = 60, seed: int = 11) -> Quality:
    """Fits vectors, network and temperature on (text, label) pairs."""
    y = np.array([label for _, label in sample], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Quality()
    rng = np.random.default_rng(seed)
    cache = RowCache()
    vectors = context_vectors([token_rows(t, cache) for t, _ in sample], index_vectors())
    x = np.array([pooled(t, vectors, cache) for t, _ in sample])
    order = rng.permutation(len(y))
    check, learn = order[: len(y) // 5], order[len(y) // 5:]
    if y[learn].min() == y[learn].max():
        learn = order
    m = Quality(vectors, x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-3)
    m.w1 = rng.normal(0, 0.1, (x.shape[1], HIDDEN))
    m.b1, m.w2 = np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN)
    weight = np.where(y == 1, 0.5 / max(y[learn].mean(), 1e-9), 0.5 / max(1 - y[learn].mean(), 1e-9))
    params = [m.w1, m.b1, m.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    z = (x - m.mean) / m.scale
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(learn), max(1, len(learn) // 64)):
            hidden = np.tanh(z[batch] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -40, 40)))
            err = (p - y[batch]) * weight[batch] / len(batch)
            back = np.outer(err, params[2]) * (1 - hidden ** 2)
            grads = [z[batch].T @ back + 1e-4 * params[0], back.sum(axis=0), hidden.T @ err + 1e-4 * params[2], np.array([err.sum()])]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] -= 0.005 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    m.w1, m.b1, m.w2, m.b2 = params[0], params[1], params[2], float(params[3][0])
    if len(check):
        logit, best = m.logits(x[check]), np.inf
        for t in np.geomspace(0.25, 8.0, 41):
            p = np.clip(1 / (1 + np.exp(-np.clip(logit / t, -40, 40))), 1e-6, 1 - 1e-6)
            loss = -np.mean(weight[check] * (y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p)))
            if loss < best:
                best, m.temperature = loss, float(t)
    return m


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Quality:
    return fit(labelled_sample(docs, labels, "quality", folds=FOLDS, held_fold=HELD_FOLD, per_class=per_class))


def score_quality(docs: DataFrame, model: Quality) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, cache = shared.value, RowCache()
        for f in frames:
            s = m.scores(f["_t"].tolist(), cache)
            yield pd.DataFrame({"doc_id": f["doc_id"], "held_out": f["held_out"], "score": s, "predicted": (s >= 0.5).astype("int32")})

    rows = docs.select(F.col("doc_id").cast("long"), fold_of("doc_id", FOLDS, HELD_FOLD).alias("held_out"),
                       F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    return rows.mapInPandas(score, SCHEMA)


def keep_good(docs: DataFrame, model: Quality) -> DataFrame:
    """The rows of ``docs``, all columns, whose whole text is predicted to be of good quality
    (all of them, if nothing could be learnt).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = shared.value, RowCache()
        for b in batches:
            s = m.scores([t or "" for t in b.column("text").to_pylist()], cache)
            yield b.filter(pa.array(s >= 0.5))

    return docs.mapInArrow(keep, docs.schema)
