"""Near duplicates by BagMinHash: signatures of weighted sets, banding, and exact
verification of multiset overlap.

Weights. A text is the multiset of its shingles of five words (letters and digits,
lower case); a text of one to four words is one shingle. Similarity is the weighted
Jaccard index: the sum of the smaller counts over the sum of the larger.

Signature. Weights are discretised into the intervals [0,1), [1,2), [2,4), [4,8), ...
Every (shingle, interval) has a Poisson process of its own, seeded by both, with a rate
equal to the interval's width. A point carries a time, a weight inside the interval
and a component of the signature; it counts if its weight is under the shingle's.
A component's value is the time of its first point. Two texts agree in a component
with a probability equal to their weighted Jaccard index, without bias. Points are made in
order of time and a process stops once it is past the largest value of the signature, so a
text needs a number of points in proportion to shingles plus components, not to their
product. All of this is vectorised over the documents of a batch.

Classes and links. Texts with equal multisets are one class (numbered by 64 bits of a
hash; n classes meet n*n/2^65 clashes, as do the hashes that fetch a class's text).
Classes that share a band meet in a bucket:

* first, every class is verified against the hub of each of its buckets (the class that meets
  most others), which turns a group of near copies into a star;
* then, in each bucket that still holds several groups (a class belongs to the hub it is
  linked to), every class outside the largest one meets all classes of other groups
  there, in blocks. A shingle that no
  other class in such buckets holds is in no intersection: the sizes without these
  shingles, and their parts by hash value, bound the similarity of a pair from above, which rules out nearly all pairs
  (two copies of one text with different edits, two texts that share a passage)
  inside the join, before they are rows.

Pairs whose sketches (a byte per component) agree in fewer than ``LEAST_AGREEING`` places are
not verified: a pair at the least similarity agrees in so few with a probability of 6e-7, the one way in which a
link between two classes of one bucket can be lost. A group of copies
does not emit all its pairs. Components are contracted in Spark (``components``).

Scale. A hot group of copies is reduced on the map side (distinct, min, count); groups and centres of stars that
hold many rows are broadcast as one small row each, the others joined by key (``joined_to_keys``); the joins
that carry a hot bucket or the texts of a hot hub are plain sort-merge joins, which adaptive
execution splits. Texts are joined only for classes that meet another one, pairs
travel with their sketches. Tables are
written to the shared folder, so lost executors cost no more than a stage.

Defined results: texts without any word (null and empty ones too: null counts as
empty) are equal only if the texts are identical; rows that repeat are copies; the class id
of a group is its smallest id (null if no member has one); an empty table gives an
empty result. Only the key and the text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined_to_keys, written
from .components import components

WORDS = 5
#: The least similarity of a link, as a fraction.
LEAST_OVERLAP = (4, 5)
BANDS, ROWS = 25, 5
COMPONENTS = BANDS * ROWS
#: Components that must agree before a pair is verified: five standard deviations under 0.8.
LEAST_AGREEING = 77
#: Shingles of the documents that are signed at once.
BATCH_SHINGLES = 200_000
#: Hash values by which shared shingles are counted, to bound intersections.
DEALT = 64
#: Classes per bucket that meet the others at a time.
BLOCK = 4096
CACHE_WORDS = 200_000
TOKEN = re.compile(r"\w+")
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    """Word -> 64-bit hash; a bounded cache."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        self[word] = h
        return h


def shingles(text: str, words: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (64-bit, ascending) of a whole text and their counts."""
    tokens = TOKEN.findall(text.lower())
    if not tokens:
        # No word: the text itself stands for it.
        return np.array([words["\0" + text]], dtype=U), np.ones(1, dtype=np.int64)
    h = np.fromiter(map(words.__getitem__, tokens), dtype=U, count=len(tokens))
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, min(len(h), WORDS), dtype=U)
    for i in range(min(len(h), WORDS)):
        out = mixed(out * U(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(out, return_counts=True)


def overlap_enough(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
    """Whether the weighted Jaccard index reaches the least similarity, in whole numbers."""
    total = int(a[1].sum() + b[1].sum())
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    over, under = LEAST_OVERLAP
    return common * under >= (total - common) * over


def processes(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """The (shingle, interval) processes of weighted shingles: document, seed, interval start, width, weight."""
    levels = np.frexp(np.maximum(weight - 1, 0).astype(np.float64))[1].astype(np.int64) + 1
    at = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels)
    start = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    return doc[at], mixed(shingle[at] + U(0xD1342543DE82EF95) * (level + 1).astype(U)), start, np.maximum(start, 1), weight[at]


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """BagMinHash signatures of weighted sets: one row a set, times as components."""
    out = np.full((len(sets), COMPONENTS), np.inf)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    shingle, weight = np.concatenate([s for s, _ in sets]), np.concatenate([w for _, w in sets])
    limit = np.full(len(sets), np.inf)
    for first in range(0, len(doc), 4 * BATCH_SHINGLES):
        part = slice(first, first + 4 * BATCH_SHINGLES)
        d, seed, start, width, w = processes(doc[part], shingle[part], weight[part])
        time, step = np.zeros(len(d)), 0
        while len(d):
            step += 1
            draw = mixed(seed + U(step * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF))
            time = time - np.log(((draw >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / width
            live = time < limit[d]
            d, seed, start, width, w, time, draw = (x[live] for x in (d, seed, start, width, w, time, draw))
            pick = mixed(draw ^ U(0xA0761D6478BD642F))
            counts = start + ((pick >> U(32)) * width.astype(U) >> U(32)).astype(np.int64) < w
            place = ((pick & U(0xFFFFFFFF)) * U(COMPONENTS) >> U(32)).astype(np.int64)
            np.minimum.at(out, (d[counts], place[counts]), time[counts])
            # A limit can fall only for sets that still have a process.
            going = np.zeros(len(sets), dtype=bool)
            going[d] = True
            limit[going] = out[going].max(axis=1)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """64-bit band values of signatures, one row a set."""
    bits = signature.view(U).reshape(len(signature), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), (len(signature), BANDS)).copy()
    for i in range(ROWS):
        h = mixed(h * U(0x9E3779B97F4A7C15) + bits[:, :, i])
    return h.view(np.int64)


def sketch(signature: np.ndarray) -> list[bytes]:
    """One byte per component: signatures to compare at a glance."""
    return [row.tobytes() for row in (mixed(signature.view(U)) >> U(56)).astype(np.uint8)]


def class_number(s: tuple[np.ndarray, np.ndarray]) -> int:
    """64 bits that stand for a multiset."""
    raw = blake2b(s[0].tobytes() + s[1].astype(np.int64).tobytes(), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def signed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its key, a hash of the text, class number, band values and sketch."""
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for f in frames:
            batch, size, first = [], 0, 0
            for i, t in enumerate(f["_t"], 1):
                batch.append(shingles(t, words))
                size += len(batch[-1][0])
                if size >= BATCH_SHINGLES or i == len(f):
                    out = f.iloc[first:i][["doc_id", "text_hash"]]
                    times = signatures(batch)
                    yield out.assign(cls=[class_number(s) for s in batch], bands=list(bands(times)), sketch=sketch(times))
                    batch, size, first = [], 0, i

    kind = docs.schema[key].dataType.simpleString()
    whole = F.coalesce(F.col(text), F.lit(""))
    # Ids may be null; a nullable integer would reach pandas as a float.
    rows = docs.select(F.col(key).cast("string").alias("doc_id"), F.xxhash64(whole).alias("text_hash"), whole.alias("_t"))
    return rows.mapInPandas(sign, "doc_id string, text_hash long, cls long, bands array<long>, sketch binary").withColumn("doc_id", F.col("doc_id").cast(kind))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of classes whose multisets overlap enough."""
    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, hubs = WordHashes(), {}
        for f in frames:
            keep = []
            for b, ta, tb in zip(f["b"], f["ta"], f["tb"]):
                if b not in hubs:
                    if len(hubs) >= 64:
                        hubs.clear()
                    hubs[b] = shingles(tb, words)
                keep.append(overlap_enough(shingles(ta, words), hubs[b]))
            yield f.loc[keep, ["a", "b"]]

    rows = (pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b"))
    return rows.select("a", "b", "ta", "tb").mapInPandas(verify, "a long, b long")


def screened(met: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of ``met`` (a, b, sa, sb) whose sketches agree in enough places.

    The share of equal components estimates the similarity; pairs more than five standard
    deviations under the least similarity are not worth reading their texts.
    """
    def screen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                a, b = (np.frombuffer(b"".join(f[c]), dtype=np.uint8).reshape(len(f), COMPONENTS) for c in ("sa", "sb"))
                yield f.loc[(a == b).sum(axis=1) >= LEAST_AGREEING, ["a", "b"]]

    return met.select("a", "b", "sa", "sb").mapInPandas(screen, "a long, b long").distinct()


def possible_links(open_classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Per class: cls, size (shingles with repetition), shared (those that another of the
    classes holds too, at most) and dealt (the shared ones by ``DEALT`` values of their hash).
    Classes that share too little for any link are left out."""
    def postings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for f in frames:
            for c, t in zip(f["cls"], f["text"]):
                s, n = shingles(t, words)
                yield pd.DataFrame({"cls": np.full(len(s), c), "shingle": s.view(np.int64), "n": n})

    held = written(texts.join(open_classes, "cls", "left_semi").mapInPandas(postings, "cls long, shingle long, n long"), "near-postings")
    deal = F.pmod("shingle", F.lit(DEALT)).alias("d")
    # A shingle that one class alone holds is in no intersection.
    alone = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("k"), F.max("cls").alias("cls"), F.max("n").alias("n")).where("k = 1")
    own = held.groupBy("cls", deal).agg(F.sum("n").alias("n"))
    lost = alone.groupBy("cls", deal).agg(F.sum("n").alias("lost"))
    each = own.join(lost, ["cls", "d"], "left").withColumn("s", F.col("n") - F.coalesce("lost", F.lit(0)))
    out = each.groupBy("cls").agg(F.sum("n").alias("size"), F.sum("s").alias("shared"), F.map_from_entries(F.collect_list(F.struct("d", "s"))).alias("_m"))
    out = out.where(F.col("shared") * LEAST_OVERLAP[1] >= F.col("size") * LEAST_OVERLAP[0])
    return out.select("cls", "size", "shared", F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(DEALT - 1).cast("long")), lambda i: F.coalesce(F.col("_m")[i], F.lit(0)).cast("int")).alias("dealt"))


def may_link() -> Column:
    """Whether the sizes of two classes (columns x..., y...) allow a link: no more can be
    common than the smaller shared part, and than the smaller part under each hash value."""
    over, under = LEAST_OVERLAP

    def reaches(common: Column) -> Column:
        return common * under >= (F.col("xsize") + F.col("ysize") - common) * over

    by_hash = F.aggregate(F.zip_with("xdealt", "ydealt", lambda x, y: F.least(x, y)), F.lit(0), lambda n, m: n + m)
    return reaches(F.least("xshared", "yshared")) & reaches(by_hash)


def class_links(rows: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """Components of classes that are near duplicates: node, root. ``rows``: the written result of ``signed``."""
    posted = rows.select("cls", F.explode("bands").alias("bucket")).distinct()
    sizes = posted.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Only buckets where classes meet matter from here on.
    posted = written(posted.join(sizes, "bucket"), "near-buckets")
    # A class that meets many others is near the centre of its group: it links to most of them.
    meeting = posted.groupBy("cls").agg(F.sum("n").alias("met"))
    classes = rows.groupBy("cls").agg(F.first("sketch").alias("sketch"), F.min("text_hash").alias("text_hash"))
    classes = written(classes.join(meeting, "cls"), "near-classes")
    posted = written(posted.drop("n").join(classes.drop("text_hash"), "cls"), "near-posted")
    hubs = posted.groupBy("bucket").agg(F.max(F.struct("met", "cls", "sketch")).alias("hub"))
    met = posted.join(hubs, "bucket").where(F.col("cls") != F.col("hub.cls")).select(
        F.greatest("cls", "hub.cls").alias("a"), F.least("cls", "hub.cls").alias("b"),
        F.when(F.col("cls") > F.col("hub.cls"), F.col("sketch")).otherwise(F.col("hub.sketch")).alias("sa"),
        F.when(F.col("cls") > F.col("hub.cls"), F.col("hub.sketch")).otherwise(F.col("sketch")).alias("sb"))
    # One text for every class that meets another one. Both sides grow with the table: no broadcast at any size.
    whole = F.coalesce(F.col(text), F.lit(""))
    texts = written(docs.select(whole.alias("text"), F.xxhash64(whole).alias("text_hash")).join(classes.select("cls", "text_hash").hint("merge"), "text_hash")
                    .groupBy("cls").agg(F.first("text").alias("text")), "near-texts")
    tried = written(screened(met), "near-pairs")
    links = written(verified(tried, texts), "near-links")

    # Buckets that hold several groups: every class outside the largest one against all of other groups.
    placed = posted.select("bucket", "cls", "sketch").join(nearest_hubs(links, classes), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    placed = written(placed.join(buckets_open(placed), "bucket"), "near-open")
    possible = possible_links(placed.select("cls").distinct(), texts)
    placed = written(placed.join(possible, "cls"), "near-open")
    rest = placed.where("root <> largest")
    most = rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    columns = ("cls", "root", "sketch", "size", "shared", "dealt")
    for part in range(-(-(most or 0) // BLOCK)):
        taken = rest.where(F.pmod(F.xxhash64("cls"), F.lit(-(-most // BLOCK))) == part)
        met = (taken.select("bucket", *[F.col(c).alias("x" + c) for c in columns])
               .join(placed.select("bucket", *[F.col(c).alias("y" + c) for c in columns]), "bucket")
               .where((F.col("xroot") != F.col("yroot")) & may_link())
               .select(F.greatest("xcls", "ycls").alias("a"), F.least("xcls", "ycls").alias("b"),
                       F.when(F.col("xcls") > F.col("ycls"), F.col("xsketch")).otherwise(F.col("ysketch")).alias("sa"),
                       F.when(F.col("xcls") > F.col("ycls"), F.col("ysketch")).otherwise(F.col("xsketch")).alias("sb")))
        fresh = written(screened(met).join(tried, ["a", "b"], "left_anti"), "near-pairs")
        tried = tried.unionByName(fresh)
        links = links.unionByName(verified(fresh, texts))
    return components(links)


def nearest_hubs(links: DataFrame, classes: DataFrame) -> DataFrame:
    """Per linked class, root: the class it is linked to that meets most others, or itself if it meets more.

    A label that groups most of a component, at the price of one aggregate: two classes of
    one component under different labels cost a comparison, never a link.
    """
    met = classes.select(F.col("cls").alias("b"), F.struct("met", "cls").alias("_m"))
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = both.join(met, "b").groupBy("a").agg(F.max("_m").alias("_best"))
    own = classes.select(F.col("cls").alias("a"), F.struct("met", "cls").alias("_own"))
    return best.join(own, "a").select(F.col("a").alias("cls"), F.greatest("_best", "_own")["cls"].alias("root"))


def buckets_open(placed: DataFrame) -> DataFrame:
    """Buckets with several components, and the largest of these: bucket, largest."""
    sizes = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    return (sizes.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.count(F.lit(1)).alias("parts"))
            .where("parts > 1").drop("parts"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest id of its group), group_size,
    kept (it is the row with this id, or of its repetitions), text_hash."""
    rows = written(signed(docs, key, text), "near-signed")
    found = class_links(rows, docs, text)
    # The first of a group has the smallest id; rows without id come last, by their text.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    each = rows.groupBy("cls").agg(first.alias("_first"), F.count(F.lit(1)).alias("_n"))
    each = written(each.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls")), "near-roots")
    total = written(each.groupBy("root").agg(F.min("_first").alias("first"), F.sum("_n").alias("group_size"), F.count(F.lit(1)).alias("_rows")), "near-groups")
    named = written(joined_to_keys(each.select("cls", "root"), total, "root").drop("root"), "near-classes")
    return rows.select("doc_id", "text_hash", "cls").join(named, "cls").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "group_size",
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))).alias("kept"), "text_hash")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: the first document of each group of near
    duplicates (smallest id; rows without id last). Of rows that repeat it the least in all columns stays."""
    kept = written(near_duplicates(docs, key, text).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h"), F.col("group_size").alias("_n")).distinct(), "near-kept")
    rows = docs.join(kept, docs[key].eqNullSafe(kept["_id"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == kept["_h"]))
    single = rows.where("_n = 1").select(*docs.columns)
    several = rows.where("_n > 1").groupBy("_id", "_h").agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return single.unionByName(several)
