"""BPE encoding and decoding with a public vocabulary, by backtracking over
longest token matches.

Encoding a word. An Aho-Corasick automaton over all tokens finds, in one pass, every
token that matches anywhere in the word. From the left, the longest token that may
follow the previous one is taken; a *pair-compatibility table* tells whether two
adjacent tokens can both come out of the merge process (they cannot if, at some
moment of building them, a merge across their border had a lower rank than the
merges that went on). For most words this plain run of longest matches is the
answer. Elsewhere, where no token fits, the last one is given up for its next
shorter choice. A prefix of a word has at most one valid encoding, so a position that
failed once is never tried again, and the work is linear in the word.
The result equals the merge process itself.

Texts are normalised (NFC, white space, lower case), split at special tokens and
into words by the vocabulary's own pattern. White-space separated chunks repeat a lot;
their packed ids are kept in a bounded cache per task.

Decoding looks tokens up in one byte string by an offset table (vectorised):
this vocabulary has no decoder, so the library's ``decode`` joins token strings by
spaces, and so does this.

The vocabulary file is read once on the driver from a path that is a parameter; its
tables (under 4 MB) are broadcast. Encoding is one ``mapInPandas`` pass without a
shuffle. Ids are held for one row at a time.

Defined results: a null text counts as empty (no ids, empty decoded text); one
output row per input row, in any repetition; an empty table gives an empty result.
Only the key and the text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_CHUNKS, CACHE_PAIRS = 400_000, 1_000_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Fixed values of this kind of vocabulary: mark of a word's end, word pattern, white space.
WORD_END = "</w>"
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{L}\p{N}]+")
SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")
#: str.split() splits here too, the pattern's white space does not.
NOT_SPACE = regex.compile("[\x1c-\x1f]")
#: Stands for WORD_END inside the automaton; no byte is written as this character.
END = "\n"


@dataclass(frozen=True)
class Vocabulary:
    """What a vocabulary file says, small enough to broadcast."""
    tokens: tuple[str, ...]
    merges: tuple[tuple[int, int, int], ...]
    special: tuple[tuple[str, int], ...]

    @staticmethod
    def load(path: str) -> "Vocabulary":
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        ids, special = model["vocab"], [(t["content"], t["id"]) for t in data["added_tokens"]]
        names = [""] * (1 + max([*ids.values(), *(i for _, i in special)]))
        for name, i in [*ids.items(), *special]:
            names[i] = name
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return Vocabulary(tuple(names), tuple((ids[a], ids[b], ids[a + b]) for a, b in pairs), tuple(special))


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for r in (range(33, 127), range(161, 173), range(174, 256)) for b in r]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Pairs(dict):
    """Pair-compatibility table, filled on demand: ``left << 32 | right`` -> may they stand side by side."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(vocabulary.merges)}
        self.made = {t: (r, a, b) for r, (a, b, t) in reversed(list(enumerate(vocabulary.merges)))}

    def __missing__(self, pair: int) -> bool:
        if len(self) >= CACHE_PAIRS:
            self.clear()
        self[pair] = fits = self.compatible(pair >> 32, pair & 0xFFFFFFFF)
        return fits

    def compatible(self, left: int, right: int, ends: int | None = None) -> bool:
        """Walks back through the states of the two tokens' facing ends, latest merge first.
        ``ends``: the rank of the merge that joins the two, if they are parts of one token."""
        never = len(self.rank)
        left_ends = right_ends = never if ends is None else ends
        while True:
            across = self.rank.get((left, right), never)
            # Of equal merges the leftmost goes first.
            if across < left_ends and across <= right_ends:
                return False
            made_left, made_right = self.made.get(left), self.made.get(right)
            if made_left is None and made_right is None:
                return True
            if made_right is None or (made_left is not None and made_left[0] > made_right[0]):
                left_ends, left = made_left[0], made_left[2]
            else:
                right_ends, right = made_right[0], made_right[1]


class Chunks(dict):
    """White-space delimited chunk -> packed ids; a bounded cache."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        ids = self.encode(chunk)
        if len(chunk) <= 100:
            self[chunk] = ids
        return ids


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        special = {i for _, i in vocabulary.special}
        self.pairs = Pairs(vocabulary)
        self.automaton = ahocorasick.Automaton()
        # A token that the merges never make out of its own letters is in no encoding.
        unmade = set()
        for rank, (a, b, token) in enumerate(vocabulary.merges):
            if a in unmade or b in unmade or not self.pairs.compatible(a, b, rank):
                unmade.add(token)
        for i, name in enumerate(vocabulary.tokens):
            if name and i not in special and i not in unmade:
                unit = name.removesuffix(WORD_END) + END if name.endswith(WORD_END) else name
                self.automaton.add_word(unit, (len(unit), i))
        self.automaton.make_automaton()
        self.letters = byte_letters()
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s, _ in vocabulary.special) + ")") if special else None
        self.special_ids = {s: np.array([i], dtype="<u4").tobytes() for s, i in vocabulary.special}
        self.words: dict[str, bytes] = {}
        self.chunks = Chunks(self.chunk)
        names = [(n + " ").encode("utf-8") for n in vocabulary.tokens]
        self.offsets = np.concatenate([[0], np.cumsum([len(n) for n in names])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(names), dtype=np.uint8)

    def word(self, word: str) -> bytes:
        """Packed ids of one word of the pattern."""
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= CACHE_CHUNKS:
                self.words.clear()
            units = (word if word.isascii() and word.isprintable() else
                     "".join(map(self.letters.__getitem__, word.encode("utf-8", "replace")))) + END
            tokens = self.greedy(units) or self.backtracked(units)
            ids = struct.pack(f"<{len(tokens)}I", *tokens)
            if len(word) <= 100:
                self.words[word] = ids
        return ids

    def greedy(self, units: str) -> list[int] | None:
        """The run of longest matches, if it covers the word in pairs that may stand together."""
        taken, done = [], 0
        for end, (length, token) in self.automaton.iter_long(units):
            if end + 1 - length != done or (taken and not self.pairs[taken[-1] << 32 | token]):
                return None
            taken.append(token)
            done = end + 1
        return taken if done == len(units) else None

    def backtracked(self, units: str) -> list[int]:
        """The one valid run of tokens over a word, longest choices first."""
        n = len(units)
        starting: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(units):
            starting[end + 1 - match[0]].append(match)
        # Matches from one start come in order of their end: the last is the longest.
        taken: list[int] = []
        at = [0]
        dead = [False] * (n + 1)
        while at[-1] < n:
            here, choices = at[-1], starting[at[-1]]
            while choices:
                length, token = choices.pop()
                if not dead[here + length] and (not taken or self.pairs[taken[-1] << 32 | token]):
                    taken.append(token)
                    at.append(here + length)
                    break
            else:
                if not taken:
                    raise ValueError(f"the vocabulary cannot write {units!r}")
                dead[here] = True
                taken.pop()
                at.pop()
        return taken

    def chunk(self, chunk: str) -> bytes:
        """Packed ids of a text without white space."""
        if chunk.isalpha():
            ids = self.word(chunk)
        elif chunk[:-1].isalpha() and chunk[-1] in ".,":
            ids = self.word(chunk[:-1]) + self.word(chunk[-1])
        else:
            ids = b"".join(map(self.word, WORD.findall(chunk)))
        return ids

    def packed(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        parts = self.special.split(text) if self.special and "<|" in text else [text]
        out = []
        for part in parts:
            if part in self.special_ids:
                out.append(self.special_ids[part])
                continue
            plain = unicodedata.normalize("NFC", part)
            # Lower case letter by letter: a final sigma is no special case.
            plain = plain.replace("Σ", "σ").lower()
            chunks = [c for c in SPACE.split(plain) if c] if NOT_SPACE.search(plain) else plain.split()
            out.append(b"".join(map(self.chunks.__getitem__, chunks)))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()

    def decoded(self, packed: bytes) -> bytes:
        """UTF-8 of the decoded text of packed ids."""
        ids = np.frombuffer(packed, dtype="<u4")
        if not len(ids):
            return b""
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        shift = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return self.bytes[shift + np.arange(len(shift))].tobytes()[:-1]

    def decode(self, ids: list[int]) -> str:
        return self.decoded(np.array(ids, dtype="<u4").tobytes()).decode("utf-8")


@lru_cache(maxsize=2)
def codec(vocabulary: Vocabulary) -> Codec:
    """One codec a process: building the automaton takes longer than a small batch."""
    return Codec(vocabulary)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, keep_ids: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256; on request also
    the ids and the decoded text themselves."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(shared.value)
        for f in frames:
            rows = {"doc_id": f["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            if keep_ids:
                rows |= {"ids": [], "decoded": []}
            for text in f["_t"]:
                ids = c.packed(text)
                back = c.decoded(ids)
                rows["n_tokens"].append(len(ids) // 4)
                rows["ids_sha256"].append(sha256(ids).hexdigest())
                rows["decoded_sha256"].append(sha256(back).hexdigest())
                if keep_ids:
                    rows["ids"].append(np.frombuffer(ids, dtype="<u4").astype(np.int64))
                    rows["decoded"].append(back.decode("utf-8"))
            yield pd.DataFrame(rows)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    return rows.mapInPandas(encode, SCHEMA + (", ids array<long>, decoded string" if keep_ids else ""))
