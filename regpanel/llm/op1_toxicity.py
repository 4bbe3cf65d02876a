"""Toxicity by compression distance: one zstandard dictionary trained on toxic
text, one on ordinary text, and calibrated thresholds on how much shorter the
windows of a document become under the first.

Word code. Single words are too short for a byte-wise compressor to tell much
by, so a text is first written in a code of fixed width: per word 8 bytes
hashed from its first ``PREFIX`` letters and 8 bytes hashed from the whole word. A
word (or a family of words with a common stem) that a dictionary holds is then
worth several bytes of compressed length; one that it lacks cannot be compressed.

Training (on the driver, over a bounded sample of labelled rows):

1. ordinary dictionary: ``zstandard.train_dictionary`` over windows of
   ordinary documents;
2. toxic dictionary: the same trainer over the words of toxic documents which
   appear there in ``LIFT`` times as many *distinct contexts* (the word with its two
   neighbours) as in ordinary ones. A toxic document consists of ordinary words
   for the most part; and counting contexts makes a group of copies count once;
3. the classes compared are ``toxic + ordinary`` and ``random bytes of the same
   size + ordinary``. They differ in the toxic part alone and give the compressor
   tables of one shape, so a window without toxic matter has the same length under
   both;
4. the threshold on a window's saving, the ordinary rate (the part of the windows of ordinary
   texts that reach it all the same) and the weights of the logistic score are calibrated on a fold of
   the sample which neither dictionary has seen.

A text of many windows has some over the threshold by chance. It is called toxic when it has as many as
the ordinary rate would give a text of its length with a chance of ``CHANCE`` at the most (by Poisson's
distribution, one at the least); the score falls and rises with the windows under and over that count.

Scoring is a ``mapInPandas`` pass without a shuffle; the model (under 64 KB) is
broadcast. Every window of the whole text is compressed.

Defined results: a null or empty text has no window and gets the score of a
saving of 0; repeated rows are scored alike, one output row per input row; an
empty table gives an empty result; without labels of both classes the score is 0
(predicted 0). Only the key and the text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, labelled_sample

#: Labelled rows per class that the dictionaries are trained on (a bound on the driver's work).
SAMPLE_PER_CLASS = 3000
FOLDS, HELD_FOLD = 5, 0
PREFIX = 4
CODE_BYTES = 16
WINDOW_WORDS = 16
#: Windows are compressed in calls of this many, so a text of any length needs bounded memory.
CALL_WINDOWS = 4096
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 8_192
#: How often an ordinary text may have so many windows over the threshold that it is called toxic.
CHANCE = 0.02
LIFT, LEAST_CONTEXTS, LEAST_SHARE = 10.0, 5, 5e-5
#: Ends every window and both dictionaries. A frame pays for its headers only if something in
#: it can be compressed, and the compressor does not search the last bytes: with this, neither matters.
TRAILER = bytes(range(224, 256))
CACHE_WORDS = 200_000
PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&|-_"
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


class WordCodes(dict):
    """Word as written -> its code; a bounded cache."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        core = word.strip(PUNCTUATION).encode("utf-8", "surrogatepass").decode("utf-8", "replace")
        code = (blake2b(b"p" + core[:PREFIX].encode(), digest_size=8).digest()
                + blake2b(b"w" + core.encode(), digest_size=8).digest())
        self[word] = code
        return code


def windows(text: str, codes: WordCodes) -> Iterator[list[bytes]]:
    """The coded windows of a text, ``CALL_WINDOWS`` at a time."""
    words = text.lower().split()
    step, size = CALL_WINDOWS * WINDOW_WORDS, WINDOW_WORDS * CODE_BYTES
    for start in range(0, len(words), step):
        coded = b"".join(map(codes.__getitem__, words[start:start + step]))
        yield [coded[i:i + size] + TRAILER for i in range(0, len(coded), size)]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Searches every position (greedy strategy) and writes bare frames, so that
    lengths of two compressors differ by what their dictionaries hold."""
    params = zstandard.ZstdCompressionParameters.from_level(
        5, min_match=6, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=params)


def lengths(c: zstandard.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, map(c.compress, parts)), dtype=np.int64, count=len(parts))


def needed(rate: float, windows: float) -> int:
    """The least count, 1 or more, that a Poisson variable of mean ``rate * windows`` reaches with a
    probability of at most ``CHANCE``."""
    mean = rate * windows
    if mean > 500:                       # the normal tail: 2.054 standard deviations are 2 percent
        return int(mean + 2.054 * mean ** 0.5) + 1
    count, term = 1, exp(-mean)
    below = term
    while 1 - below > CHANCE:
        term *= mean / count
        below += term
        count += 1
    return count


@dataclass
class Toxicity:
    """A fitted model; ``toxic is None`` means that nothing could be learnt."""
    ordinary: bytes = b""
    toxic: bytes | None = None
    threshold: int = 0
    weights: tuple[float, float] = (0.0, 0.0)
    rate: float = 0.0

    def savings(self, texts: list[str], codes: WordCodes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: the largest saving of a window, how many reach the threshold, and how many there are."""
        filler = np.random.default_rng(3).bytes(len(self.toxic))
        plain, toxic = compressor(filler + self.ordinary + TRAILER), compressor(self.toxic + self.ordinary + TRAILER)
        most, over, count = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts))
        for i, text in enumerate(texts):
            for parts in windows(text, codes):
                saved = lengths(plain, parts) - lengths(toxic, parts)
                most[i] = max(most[i], saved.max())
                over[i] += np.count_nonzero(saved >= self.threshold)
                count[i] += len(parts)
        return most, over, count

    def scores(self, texts: list[str], codes: WordCodes) -> np.ndarray:
        if self.toxic is None or not texts:
            return np.zeros(len(texts))
        return 1.0 / (1.0 + np.exp(-self.features(texts, codes) @ np.array(self.weights)))

    def features(self, texts: list[str], codes: WordCodes) -> np.ndarray:
        """Windows beyond the count that is needed (half of one more, so that the sign decides), and the largest saving
        beyond the threshold, as less than half a window."""
        most, over, count = self.savings(texts, codes)
        beyond = over - np.array([needed(self.rate, n) for n in count])
        return np.stack([np.clip(beyond, -4, 3) + 0.5, 0.49 * np.tanh((most - self.threshold) / 8)], axis=1)


def contexts(texts: list[str], ids: dict[str, int]) -> np.ndarray:
    """Rows (word, prefix) of all distinct contexts: a word with both neighbours."""
    found = []
    for text in texts:
        words = [w.strip(PUNCTUATION) for w in text.lower().split()]
        if words:
            w = np.array([0, *(ids.setdefault(x, len(ids) + 1) for x in words), 0], dtype=np.uint64)
            key = (w[:-2] * np.uint64(0x9E3779B97F4A7C15) + w[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:]
            found.append(np.stack([key, w[1:-1]], axis=1))
    if not found:
        return np.zeros(0, dtype=np.int64)
    every = np.concatenate(found)
    return every[np.unique(every[:, 0], return_index=True)[1], 1].astype(np.int64)


def telling_words(toxic: list[str], ordinary: list[str]) -> tuple[set[str], set[str]]:
    """Words, and prefixes of words, that are frequent in toxic contexts for what they are in ordinary ones."""
    ids: dict[str, int] = {}
    in_toxic, in_ordinary = contexts(toxic, ids), contexts(ordinary, ids)
    names = ["", *ids]
    prefix_ids: dict[str, int] = {}
    prefix_of = np.array([prefix_ids.setdefault(w[:PREFIX], len(prefix_ids)) for w in names])
    prefixes = list(prefix_ids)

    def telling(a: np.ndarray, b: np.ndarray, names: list[str], shortest: int) -> set[str]:
        a, b = np.bincount(a, minlength=len(names)), np.bincount(b, minlength=len(names))
        lift = (a / max(len(in_toxic), 1)) / ((b + 1) / max(len(in_ordinary), 1))
        good = (lift >= LIFT) & (a >= max(LEAST_CONTEXTS, LEAST_SHARE * len(in_toxic)))
        return {names[i] for i in np.flatnonzero(good) if len(names[i]) >= shortest}

    return (telling(in_toxic, in_ordinary, names, 2),
            telling(prefix_of[in_toxic], prefix_of[in_ordinary], prefixes, PREFIX))


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; too few samples to train on are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=CODE_BYTES, d=8, level=5).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def fit(sample: list[tuple[str, int]], seed: int = 7) -> Toxicity:
    """Trains both dictionaries and calibrates the thresholds on (text, label) pairs."""
    rng = np.random.default_rng(seed)
    sample = [sample[i] for i in rng.permutation(len(sample))]
    cut = max(1, len(sample) // 4)
    check, learn = sample[:cut], sample[cut:]
    for part in (check, learn):
        if len({y for _, y in part}) < 2:
            check, learn = sample, sample
    toxic, ordinary = [t for t, y in learn if y], [t for t, y in learn if not y]
    if not toxic or not ordinary:
        return Toxicity()
    codes = WordCodes()
    words, prefixes = telling_words(toxic, ordinary)
    marked = [codes[w] for t in toxic for w in t.lower().split()
              if (core := w.strip(PUNCTUATION)) in words or core[:PREFIX] in prefixes]
    if not marked:
        return Toxicity()
    plain = [p.removesuffix(TRAILER) for t in ordinary for part in windows(t, codes) for p in part]
    # Random bytes between the words: what follows a word is no part of it.
    marked = [w + rng.bytes(8) for w in marked]
    m = Toxicity(train_dictionary([plain[i] for i in rng.permutation(len(plain))[:50_000]], ORDINARY_BYTES),
                 train_dictionary([b"".join(marked[i:i + 8]) for i in range(0, len(marked), 8)], TOXIC_BYTES))
    texts, y = [t for t, _ in check], np.array([y for _, y in check], dtype=np.float64)
    most, _, _ = m.savings(texts, codes)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) if 0 < y.mean() < 1 else np.ones(len(y))
    errors = [(float((weight * ((most >= k) != (y == 1))).sum()), k) for k in range(1, 25)]
    least = min(errors)[0]
    # Of the thresholds that err least, one in the lower half: a stem alone saves less than a whole word.
    good = [k for e, k in errors if e <= least + 1e-9]
    m.threshold = good[len(good) // 3]
    _, over, count = m.savings(texts, codes)
    m.rate = float(over[y == 0].sum() / max(count[y == 0].sum(), 1))
    # The weights: a small logistic regression. The second never outweighs the first, whose sign decides.
    x, w = m.features(texts, codes), np.array([1.0, 0.5])
    for _ in range(400):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 0.2 * (x * (weight * (p - y))[:, None]).mean(axis=0)
        w[0] = max(w[0], 0.1)
        w[1] = min(max(w[1], 0.0), w[0])
    m.weights = (float(w[0]), float(w[1]))
    return m


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Toxicity:
    return fit(labelled_sample(docs, labels, "toxic", folds=FOLDS, held_fold=HELD_FOLD, per_class=per_class))


def score_toxicity(docs: DataFrame, model: Toxicity) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, codes = shared.value, WordCodes()
        for f in frames:
            s = m.scores(f["_t"].tolist(), codes)
            yield pd.DataFrame({"doc_id": f["doc_id"], "held_out": f["held_out"], "score": s, "predicted": (s >= 0.5).astype("int32")})

    rows = docs.select(F.col("doc_id").cast("long"), fold_of("doc_id", FOLDS, HELD_FOLD).alias("held_out"),
                       F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    return rows.mapInPandas(score, SCHEMA)


def drop_toxic(docs: DataFrame, model: Toxicity) -> DataFrame:
    """The rows of ``docs``, all columns, whose whole text is not predicted to be toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = shared.value, WordCodes()
        for b in batches:
            s = m.scores([t or "" for t in b.column("text").to_pylist()], cache)
            yield b.filter(pa.array(s < 0.5))

    return docs.mapInArrow(keep, docs.schema)
