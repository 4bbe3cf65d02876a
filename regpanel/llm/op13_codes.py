"""Vectors compressed to one byte per part, by integer codebooks and value dictionaries.

Components become integers and a vector is cut into equal parts, each with a codebook of up to ``ENTRIES``
entries. Codebooks start as the parts of the first vectors by id; each round assigns every part to its
nearest entry and replaces entries by the floor of their parts' mean; unused entries stay.

The vectors are kept as chunks of at most ``CHUNK_ROWS`` rows. A chunk holds a *value dictionary* per
dimension, the distinct integers found there, and a matrix of dictionary codes. To assign a
chunk, the squared difference of every distinct integer to that dimension of all entries is tabulated once; the
distances of a part are then gathered by the codes and added over the part's dimensions, with no
arithmetic on vectors. All of it is in whole numbers, so results do not depend on partitioning.

Scale. Chunks are built once, written to the shared folder, and read by each of the rounds; a task holds one
chunk at a time. A round shuffles one row per task, part and entry (its sum and count), and no more rows than entries of
all codebooks come to the driver. Codebooks travel with the task; their size does not depend on the table.
Errors per label are summed before their shuffle and joined back with a salt, so a label that a
third of all rows have is dealt over many tasks.

Defined results: vectors that are null, empty, hold null or non-finite components or one of 2^18 or more in
magnitude take no part, nor those of another width than most (the larger of equals); a width that the number of parts
does not divide raises. With fewer than ``ENTRIES`` ids the codebooks are that much smaller; of an id on several rows the
least vector starts the entry; rows without an id are coded too and start the last entry. Repeated rows count, and
return, as often as they are there. An empty table gives an empty result. Only id, vector and label are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salt_count, written
from .vectors import matrix, whole_vectors

PARTS, ENTRIES, ROUNDS, FACTOR = 16, 64, 2, 256
#: Integers are below this in magnitude, so squared distances fit 64 bits.
LIMIT = 1 << 26
CHUNK_ROWS = 4096
CHUNK_SCHEMA = "ids array<long>, labels array<long>, sizes array<int>, dictionary array<long>, codes binary"


@dataclass
class Codebooks:
    entries: np.ndarray          # part, entry, position within the part

    def digest(self) -> str:
        """SHA-256 of all components as decimal integers, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def chunked(rows: DataFrame, width: int) -> DataFrame:
    """Rows (vec_id, label, x) as chunks: dictionaries per dimension and codes into them."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK_ROWS):
                batch = whole.slice(at, CHUNK_ROWS)
                values, codes = zip(*(np.unique(c, return_inverse=True) for c in matrix(batch.column("x"), width).T))
                packed = np.stack([c.reshape(-1) for c in codes]).astype(np.uint16)
                one = lambda items, kind: pa.array([items], type=pa.list_(kind))
                yield pa.RecordBatch.from_arrays(
                    [one(batch.column("vec_id").to_pylist(), pa.int64()), one(batch.column("label").to_pylist(), pa.int64()),
                     one([len(v) for v in values], pa.int32()), one(np.concatenate(values), pa.int64()), pa.array([packed.tobytes()], type=pa.binary())],
                    names=["ids", "labels", "sizes", "dictionary", "codes"])

    return rows.select("vec_id", "label", "x").mapInArrow(build, CHUNK_SCHEMA)


def unpacked(chunk: dict) -> tuple[list[np.ndarray], np.ndarray]:
    """The dictionaries of a chunk and its codes, one row per dimension."""
    values = np.split(np.array(chunk["dictionary"], dtype=np.int64), np.cumsum(chunk["sizes"])[:-1])
    return values, np.frombuffer(chunk["codes"], dtype=np.uint16).reshape(len(values), -1)


def assigned(values: list[np.ndarray], codes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lower) and squared distance per row and part, by gathers and adds."""
    parts, count, width = entries.shape
    best, error = np.empty((codes.shape[1], parts), dtype=np.int64), np.empty((codes.shape[1], parts), dtype=np.int64)
    for part in range(parts):
        total = np.zeros((codes.shape[1], count), dtype=np.int64)
        for position in range(width):
            dimension = part * width + position
            table = (values[dimension][:, None] - entries[part, :, position][None, :]) ** 2
            total += table[codes[dimension]]
        best[:, part] = total.argmin(axis=1)
        error[:, part] = np.take_along_axis(total, best[:, part, None], axis=1)[:, 0]
    return best, error


def first_entries(rows: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """Codebooks made of the parts of the ``entries`` smallest ids."""
    ids = [r["vec_id"] for r in rows.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    of_them = F.col("vec_id").isin([i for i in ids if i is not None])
    first = rows.where(of_them | F.col("vec_id").isNull() if None in ids else of_them).groupBy("vec_id").agg(F.min("x").alias("x"))
    least = first.orderBy(F.asc_nulls_last("vec_id")).collect()
    return np.array([r["x"] for r in least], dtype=np.int64).reshape(len(least), parts, width // parts).transpose(1, 0, 2)


def updated(chunks: DataFrame, entries: np.ndarray) -> np.ndarray:
    """Entries replaced by the floor of the mean of the parts assigned to them."""
    parts, count, width = entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = np.zeros((parts, count), dtype=np.int64), np.zeros((parts, count, width), dtype=np.int64)
        for batch in batches:
            for chunk in batch.to_pylist():
                values, codes = unpacked(chunk)
                best, _ = assigned(values, codes, entries)
                for part in range(parts):
                    np.add.at(number[part], best[:, part], 1)
                    for position in range(width):
                        dimension = part * width + position
                        np.add.at(total[part, :, position], best[:, part], values[dimension][codes[dimension]])
        part, entry = np.nonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(part, type=pa.int32()), pa.array(entry, type=pa.int32()), pa.array(number[part, entry]),
                                          pa.array(list(total[part, entry]), type=pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

    found = chunks.mapInArrow(sums, "part int, entry int, n long, total array<long>")
    each = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)]
    new = entries.copy()
    for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect():
        new[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return new


def coded(chunks: DataFrame, entries: np.ndarray) -> DataFrame:
    """Columns vec_id, label, code (a byte per part), error."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pylist():
                best, error = assigned(*unpacked(chunk), entries)
                yield pa.RecordBatch.from_arrays([pa.array(chunk["ids"], type=pa.int64()), pa.array(chunk["labels"], type=pa.int64()),
                                                  pa.array([row.tobytes() for row in best.astype(np.uint8)], type=pa.binary()), pa.array(error.sum(axis=1))],
                                                 names=["vec_id", "label", "code", "error"])

    return chunks.mapInArrow(assign, "vec_id long, label long, code binary, error long")


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR) -> tuple[DataFrame, Codebooks]:
    """Codes of all vectors that take part (vec_id, label, code binary, error, label_error), and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    marked = F.col(label).cast("long") if label else F.lit(None).cast("long")
    rows, width = whole_vectors(vectors, vector, factor, LIMIT, F.col(key).cast("long").alias("vec_id"), marked.alias("label"))
    if width % parts:
        raise ValueError(f"{parts} equal parts cannot be cut from {width} components")
    books = first_entries(rows, width, parts, entries)
    chunks = written(chunked(rows, max(width, 1)), "vector-chunks")
    for _ in range(rounds if width else 0):
        books = updated(chunks, books)
    codes = written(coded(chunks, books), "vector-codes")
    salts = salt_count(vectors.sparkSession)
    sums = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    sums = written(sums, "label-errors").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = codes.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    both = dealt.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")) & (F.col("c._salt") == F.col("s._salt")))
    return both.select("c.vec_id", "c.label", "c.code", "c.error", "s.label_error"), Codebooks(books)


def code_rows(codes: DataFrame, books: Codebooks) -> DataFrame:
    """Columns vec_id, code (hexadecimal), error, label_error, codebooks_sha256."""
    return codes.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _oracle() -> str:
    """Two rounds and the last assignment as DuckDB SQL; distances are sums of products of integers, exact in doubles."""
    near = """a{n} AS (SELECT id, part, min({{'d': list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c), 'e': entry}}) AS best
         FROM p JOIN c{n} USING (part) GROUP BY id, part)"""
    step = """m{n} AS (SELECT part, entry, list(floor(s / k) ORDER BY pos) AS c FROM (
         SELECT p.part, best.e AS entry, pos, sum(v[pos]) AS s, count(*) AS k FROM a{n} JOIN p USING (id, part), range(1, 5) r(pos)
         GROUP BY ALL) GROUP BY part, entry),
c{m} AS (SELECT part, entry, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (part, entry))"""
    chain = ",\n".join(x for n in range(ROUNDS) for x in (near.format(n=n), step.format(n=n, m=n + 1)))
    return f"""
WITH k AS (SELECT row_number() OVER () AS id, vec_id, label, [floor({FACTOR} * x::DOUBLE) FOR x IN embedding] AS w FROM embeddings
      WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT id, vec_id, part, w[part * 4 + 1 : part * 4 + 4] AS v FROM k, range({PARTS}) r(part)),
c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS c FROM p
       QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {ENTRIES}),
{chain},
{near.format(n=ROUNDS)},
h AS (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
      FROM (SELECT part, entry, unnest(c) AS x, generate_subscripts(c, 1) AS pos FROM c{ROUNDS})),
o AS (SELECT id, string_agg(lower(printf('%02x', best.e::INT)), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY id)
SELECT k.vec_id, o.code, o.error, (sum(o.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, h.codebooks_sha256
FROM o JOIN k USING (id), h
"""


ORACLE_SQL = _oracle()
