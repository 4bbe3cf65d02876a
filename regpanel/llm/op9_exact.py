"""Exact duplicates of a batch against an immutable snapshot, screened by static
binary-fuse filters.

A snapshot is indexed once: its digests are grouped (largest id, number of rows),
dealt into shards by their leading bytes, and every shard gets a static binary-fuse
filter (8-bit fingerprints, three probes, about 9 bits a digest, 1 in 256 false
positives). An incoming batch is grouped among itself first (so that its own
duplicates meet there), its digests are screened by the filter of their shard, and
only the positives join the snapshot's exact buckets. The texts of groups with more
than one member are then compared byte for byte, as a set of texts per digest; texts
that differ under the same digest are grouped by their own bytes.

Scale. All shuffles before the byte check carry digests and ids only, and are
pre-aggregated, so a digest that a third of all rows share arrives as one row per
map task. Shards follow the digest, which spreads evenly, and their number
follows the number of digests. The byte check moves a text once at the most, and of a
group's copies one per map task; where few digests have copies, only these texts move. Filters stay in the tables of Spark; nothing is collected.

Defined results: a null text counts as empty, so null and empty texts are equal.
Of equal texts the largest id stays; rows that repeat this id stay together; a row
without an id stays only if no row of its group has one. An empty table gives an
empty result. Only the key and the text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined_to_keys, written

#: Digests a shard holds on average: a filter is built from so many at once.
DIGESTS_PER_SHARD = 50_000
#: The most digests that are broadcast to leave texts without copies where they are.
FEW_DIGESTS = 200_000
FILTER_SCHEMA = "shard long, seed long, segment long, segments long, prints binary"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finalizer over keys and a seed."""
    x = keys ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def probes(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of every key, in consecutive segments, and its fingerprint."""
    x = mix(keys, seed)
    first = ((x >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    y = mix(x, seed + 1)
    mask = np.uint64(segment - 1)
    at = [(first + np.uint64(i)) * np.uint64(segment) + ((y >> np.uint64(20 * i)) & mask) for i in range(3)]
    return np.stack(at, axis=1).astype(np.int64), (x & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, segments and fingerprints of a static filter over distinct 64-bit keys.

    Slots that a single key probes are peeled round by round; fingerprints are
    assigned in reverse. A seed whose graph cannot be peeled is replaced.
    """
    n = len(keys)
    # Sizes as published for three probes: longer segments and less spare room for more keys.
    logn = np.log(max(n, 2))
    segment = min(1 << 18, 1 << max(2, int(logn / np.log(3.33) + 2.25)))
    segments = max(1, int(np.ceil(n * (0.875 + 0.25 * max(1.0, np.log(1e6) / logn)) / segment)) - 2)
    for seed in range(1000):
        if seed % 10 == 9:
            segments += 1 + segments // 8
        at, prints = probes(keys, seed, segment, segments)
        size = (segments + 2) * segment
        count = np.bincount(at.ravel(), minlength=size)
        owner = np.zeros(size, dtype=np.int64)
        np.bitwise_xor.at(owner, at.ravel(), np.repeat(np.arange(n), 3))
        rounds, left = [], n
        while left:
            slots = np.flatnonzero(count == 1)
            if not len(slots):
                break
            key, where = np.unique(owner[slots], return_index=True)
            slots = slots[where]
            rounds.append((key, slots))
            np.subtract.at(count, at[key].ravel(), 1)
            np.bitwise_xor.at(owner, at[key].ravel(), np.repeat(key, 3))
            left -= len(key)
        if not left:
            out = np.zeros(size, dtype=np.uint8)
            for key, slots in reversed(rounds):
                out[slots] = 0
                out[slots] = prints[key] ^ out[at[key, 0]] ^ out[at[key, 1]] ^ out[at[key, 2]]
            return seed, segment, segments, out.tobytes()
    raise RuntimeError("no seed gives a filter over these keys")


def in_filter(keys: np.ndarray, seed: int, segment: int, segments: int, prints: bytes) -> np.ndarray:
    """Whether the filter may hold each key: never false for a key it was built from."""
    table = np.frombuffer(prints, dtype=np.uint8)
    at, own = probes(keys, seed, segment, segments)
    return (table[at[:, 0]] ^ table[at[:, 1]] ^ table[at[:, 2]]) == own


def digest_keys(digests: pd.Series) -> np.ndarray:
    """64 bits of hexadecimal digests, beyond the bytes that deal out the shards."""
    return np.array([int(d[16:32], 16) for d in digests], dtype=np.uint64)


def shard_of(digest: Column, shards: int) -> Column:
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % shards


def with_digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, text (null: empty) and text_sha256."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), whole.alias("text"), F.sha2(whole.cast("binary"), 256).alias("text_sha256"))


def grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: text_sha256, keep_id, group_size."""
    return rows.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def build_filters(groups: DataFrame, shards: int) -> DataFrame:
    """One static filter per shard of a snapshot's digests."""
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, prints = build_filter(np.unique(digest_keys(frame["text_sha256"])))
        return pd.DataFrame({"shard": [frame["shard"].iloc[0]], "seed": [seed], "segment": [segment], "segments": [segments], "prints": [prints]})

    return (groups.select(shard_of(F.col("text_sha256"), shards).alias("shard"), "text_sha256")
            .groupBy("shard").applyInPandas(build, FILTER_SCHEMA))


def screened(groups: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """``groups`` with a column ``maybe``: whether the snapshot's filter lets the digest through."""
    def screen(frame: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = frame[["text_sha256", "keep_id", "group_size"]].copy()
        if len(own) and len(out):
            f = own.iloc[0]
            out["maybe"] = in_filter(digest_keys(out["text_sha256"]), int(f["seed"]), int(f["segment"]), int(f["segments"]), f["prints"])
        else:
            out["maybe"] = False
        return out

    dealt = groups.withColumn("shard", shard_of(F.col("text_sha256"), shards))
    # Ids may be null; a nullable integer would reach pandas as a float.
    ids = dealt.withColumn("keep_id", F.col("keep_id").cast("string"))
    out = (ids.groupBy("shard").cogroup(filters.groupBy("shard"))
           .applyInPandas(screen, "text_sha256 string, keep_id string, group_size long, maybe boolean"))
    return out.withColumn("keep_id", F.col("keep_id").cast(groups.schema["keep_id"].dataType))


def merge_groups(snapshot: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row per digest over a snapshot and a batch, both one row per digest.

    Incoming digests that the filters pass join the snapshot's exact buckets; the
    others are new and skip the join.
    """
    snapshot, incoming = written(snapshot, "snapshot-digests"), written(incoming, "incoming-digests")
    shards = max(1, -(-snapshot.count() // DIGESTS_PER_SHARD))
    filters = build_filters(snapshot, shards)
    batch = written(screened(incoming, filters, shards), "screened-digests")
    positive = batch.where("maybe").select("text_sha256", F.col("keep_id").alias("_id"), F.col("group_size").alias("_n"))
    both = snapshot.join(positive, "text_sha256", "full_outer").select(
        "text_sha256", F.greatest("keep_id", "_id").alias("keep_id"),
        (F.coalesce("group_size", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("group_size"))
    return both.unionByName(batch.where(~F.col("maybe")).drop("maybe"))


def exact_duplicates(docs: DataFrame, in_snapshot: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Decision for every row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``in_snapshot`` (over the columns doc_id, text, text_sha256) tells which rows
    are the indexed snapshot; the others are the incoming batch.
    """
    rows = with_digest(docs, key, text)
    ids = written(rows.select("doc_id", "text_sha256", F.coalesce(in_snapshot, F.lit(False)).alias("_old")), "digests")
    groups = written(merge_groups(grouped(ids.where("_old")), grouped(ids.where(~F.col("_old")))), "digest-groups")

    # The byte check: the set of texts under each digest of several rows. Copies are one text per map task.
    several = groups.where("group_size > 1").select("text_sha256")
    if several.count() <= FEW_DIGESTS:
        rows_of_several = rows.join(F.broadcast(several), "text_sha256", "left_semi")
    else:
        rows_of_several = rows          # no text moves more than once, whichever
    texts = rows_of_several.groupBy("text_sha256").agg(F.size(F.collect_set("text")).alias("texts"))
    clashing = written(texts.where("texts > 1").select("text_sha256"), "digest-clashes")

    decided = joined_to_keys(ids.drop("_old"), groups.withColumn("_rows", F.col("group_size")), "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    if clashing.isEmpty():
        return decided
    # Different texts under one digest: groups by the bytes themselves, for these digests alone.
    apart = rows.join(clashing, "text_sha256", "left_semi")
    own = apart.groupBy("text_sha256", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    redone = apart.join(own, ["text_sha256", "text"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return decided.join(clashing, "text_sha256", "left_anti").select(redone.columns).unionByName(redone)


def drop_duplicates(docs: DataFrame, in_snapshot: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one row of equal texts, with the largest
    id. Of rows that repeat an id and text (or have no id) the least in all columns stays."""
    decided = exact_duplicates(docs, in_snapshot, key, text)
    kept = written(decided.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("group_size").alias("_n")).distinct(), "kept-digests")
    whole = docs.withColumn("_sha2", F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    rows = whole.join(kept, (F.col("_sha2") == F.col("_sha")) & F.col(key).eqNullSafe(F.col("_id")))
    # A row that no other equals in text needs no comparison.
    single = rows.where("_n = 1").select(*docs.columns)
    several = rows.where("_n > 1").groupBy("_sha").agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return single.unionByName(several)


def half_by_id(key: str = "doc_id") -> Column:
    """The driver table is one table: rows with an even hash of the id play the snapshot."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0
