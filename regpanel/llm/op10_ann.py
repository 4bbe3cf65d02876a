"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors. Every vector is represented by the order of
its nearest pivots; shards of the index hold *pivot inverted files*: for each pivot the
vectors that have it among their first ``POSTED``, with its position. A query walks the
files of its own first ``PROBED`` pivots, which accumulates the Spearman footrule
distance of the two orders (a pivot missing from an order stands right behind its end):
the distance falls by ``2 * (PROBED - max(position, position))`` for each pivot shared. The
``RERANKED`` part of a shard that is nearest by footrule (ties included; ``OVERSAMPLED`` times as many as are
wanted at the least) is reranked by the exact inner product, the best per shard are merged per query.

The measure is the inner product, so vectors get one more component that makes all
norms equal, which turns largest inner product into smallest angle; equal norms stay as
they are. Pivots are a sample of at most ``PIVOTS`` vectors taken by a hash of the id (all vectors, if there are fewer:
orders of few pivots tell little); every vector is indexed. Recall is measured against brute force in the tests and README.

Scale. The stated query set meets all rows in blocks: shards of about ``SHARD_ROWS``
vectors and blocks of about ``QUERY_ROWS`` queries, dealt by a hash of the id, so a task's
memory does not depend on the table. A shard returns K rows per query; the merge is
a window with a group limit before its shuffle.

Defined results: vectors that are null, empty, zero, hold null or non-finite components, have no id
or another number of components than most (the larger of equals) take no part; rows that
repeat an id count once, with the least vector; of equal scores the smaller id comes first;
a query has fewer than K rows if there are fewer candidates; an empty table gives an
empty result. Only id and vector are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

K = 20
#: The most pivots (a bounded sample), pivots a vector is posted under, and pivots a query probes.
PIVOTS, POSTED, PROBED = 2048, 32, 64
#: Part of a shard that is reranked exactly, and the least number per neighbour wanted.
RERANKED, OVERSAMPLED = 0.2, 3
SHARD_ROWS, QUERY_ROWS = 4096, 4096
SCHEMA = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Columns vec_id and v (array of double) of the vectors that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & some)
    width = rows.groupBy(F.size("v").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("w")).first()
    return rows.where(F.size("v") == (width["w"] if width else -1))


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the ``count`` pivots of largest inner product, nearest first, per row."""
    out = np.empty((len(x), count), dtype=np.int16)
    for i in range(0, len(x), 1024):
        near = -(x[i:i + 1024] @ pivots.T)
        part = np.argpartition(near, count - 1, axis=1)[:, :count]
        out[i:i + 1024] = np.take_along_axis(part, np.argsort(np.take_along_axis(near, part, axis=1), axis=1, kind="stable"), axis=1)
    return out


def levelled(v: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the component that lifts their norm to ``most``, in single precision."""
    rest = np.sqrt(np.maximum(most * most - (v * v).sum(axis=1), 0.0))
    return np.concatenate([v, rest[:, None]], axis=1).astype(np.float32)


def once(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (ascending, each once), vectors and pivot orders of a group's rows."""
    ids = frame["vec_id"].to_numpy()
    v, order = np.array(frame["v"].tolist(), dtype=np.float64), np.array(frame["pivots"].tolist(), dtype=np.int16)
    place = np.lexsort((*v.T[::-1], ids))
    place = place[np.concatenate([[True], ids[place][1:] != ids[place][:-1]])]
    return ids[place], v[place], order[place]


def search(ids: np.ndarray, v: np.ndarray, orders: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
           query_orders: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its best ``k`` of a shard: query id, ids, scores."""
    posted = min(POSTED, orders.shape[1])
    probed = query_orders.shape[1]
    flat = orders[:, :posted].ravel().astype(np.int64)
    by_pivot = np.argsort(flat, kind="stable")
    files = np.searchsorted(flat[by_pivot], np.arange(PIVOTS + 1))
    rows, position = by_pivot // posted, (by_pivot % posted).astype(np.int64)
    rerank = max(OVERSAMPLED * k, int(np.ceil(RERANKED * len(ids))))
    for qid, q, order in zip(query_ids, queries, query_orders):
        near = np.zeros(len(ids), dtype=np.int64)
        for at, pivot in enumerate(order):
            file = slice(files[pivot], files[pivot + 1])
            near[rows[file]] += probed - np.maximum(position[file], at)
        near[ids == qid] = -1
        if rerank < len(ids):
            found = np.flatnonzero(near >= max(np.partition(near, len(ids) - rerank)[len(ids) - rerank], 0))
        else:
            found = np.flatnonzero(near >= 0)
        if not len(found):
            continue
        rough = v[found] @ q
        if len(found) > k:
            # All that may be among the best; equal vectors must get equal scores, so these are summed anew.
            found = found[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - 1e-9 * max(1.0, float(np.abs(rough).max()))]
        score = (v[found] * q).sum(axis=1)
        best = np.lexsort((ids[found], -score))[:k]
        yield int(qid), ids[found][best], score[best]


def neighbours(vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest found for every query (``is_query`` over vec_id): query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("most")).first()
    n, most = size["n"], float(size["most"] or 1.0)
    wanted = max(1, min(PIVOTS, n))
    token = F.pmod(F.xxhash64("vec_id", F.lit(29)), F.lit(1 << 30))
    sample = rows.where(token < min(1 << 30, (1 << 30) * 2 * (wanted + 50) // max(n, 1))).orderBy(token, "vec_id", "v").limit(wanted)
    pivots = levelled(np.array([r["v"] for r in sample.collect()] or [[0.0]], dtype=np.float64), most)
    shared = spark.sparkContext.broadcast(pivots)
    kept = min(PROBED, len(pivots))

    def represent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            v = np.array(f["v"].tolist(), dtype=np.float64)
            # The norms differ by rounding alone where they are meant to be equal.
            out = f.assign(pivots=list(nearest_pivots(levelled(v, most), shared.value, kept)))
            # A query points at what an equal direction with all of the norm in it would.
            plain = np.concatenate([v, np.zeros((len(v), 1))], axis=1).astype(np.float32)
            yield out.assign(probes=list(nearest_pivots(plain, shared.value, kept)))

    index = written(rows.mapInPandas(represent, "vec_id long, v array<double>, pivots array<short>, probes array<short>"), "permutations")
    asked = index.where(is_query)
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-asked.count() // QUERY_ROWS))
    place = F.xxhash64("vec_id", F.lit(31))
    posts = index.select("vec_id", "v", "pivots", F.pmod(place, F.lit(shards)).alias("shard"),
                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = asked.select("vec_id", "v", F.col("probes").alias("pivots"), F.pmod(place, F.lit(blocks)).cast("int").alias("block"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))

    def meet(posted: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(posted) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = list(search(*once(posted), *once(asked), k))
        return pd.DataFrame({"query_id": np.repeat([q for q, _, _ in found], [len(i) for _, i, _ in found]) if found else [],
                             "vec_id": np.concatenate([i for _, i, _ in found]) if found else [],
                             "score": np.concatenate([s for _, _, s in found]) if found else []})

    best = posts.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(meet, SCHEMA)
    ranked = best.withColumn("rank", F.expr("row_number() over (partition by query_id order by score desc, vec_id)"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

