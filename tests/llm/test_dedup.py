import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from corpus_fixtures import edge_docs, no_docs  # noqa: F401  (fixtures)
from regpanel.llm import op4_minhash, op9_exact
from regpanel.llm.components import components


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 17, 1000, 30_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        f = op9_exact.build_filter(keys)
        assert op9_exact.in_filter(keys, *f).all()
        others = rng.integers(1 << 63, (1 << 64) - 1, 20_000, dtype=np.uint64)
        assert op9_exact.in_filter(others, *f).mean() < 0.012
        if n > 10_000:
            assert len(f[3]) < 1.45 * n


def expected_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep))
    return sorted(out, key=str)


@pytest.mark.parametrize("snapshot", ["doc_id % 2 = 0", "true", "false", "doc_id is null"])
def test_exact_groups(spark, edge_docs, no_docs, snapshot):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = op9_exact.exact_duplicates(edge_docs, F.expr(snapshot)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == expected_exact(rows)
    assert op9_exact.exact_duplicates(no_docs, F.expr(snapshot)).collect() == []


def test_exact_byte_check(spark, monkeypatch):
    # A digest that does not tell texts apart: the bytes do.
    monkeypatch.setattr(op9_exact, "with_digest", lambda docs, key="doc_id", text="text": docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.sha2(F.lit("same").cast("binary"), 256).alias("text_sha256")))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "doc_id long, text string")
    got = {(r.doc_id, r.keep_id, r.group_size) for r in op9_exact.exact_duplicates(docs, F.lit(True)).collect()}
    assert got == {(1, 3, 2), (3, 3, 2), (2, 2, 1), (4, 4, 1)}


def test_drop_duplicates_keeps_one_row(edge_docs):
    kept = op9_exact.drop_duplicates(edge_docs, op9_exact.half_by_id())
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [5, 3, 4, None, 6, 7, 8]))


def test_components(spark):
    rng = random.Random(2)
    for links in ([], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]):
        parent = {x: x for l in links for x in l}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in links:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
        expected = {x: find(x) for x in parent if any(x in l and l[0] != l[1] for l in links)}
        got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == expected


def near_corpus(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    docs = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(8, 300))]
        docs.append(base)
        for _ in range(rng.choice([0, 1, 2, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(copy)
    # A shared passage that is not enough for a link, and repeated shingles.
    passage = [rng.choice(words) for _ in range(60)]
    docs += [passage + [rng.choice(words) for _ in range(40)] for _ in range(15)]
    docs += [["a", "b", "c", "d", "e"] * k for k in (3, 30, 31, 33)]
    rng.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


def brute_near(rows):
    words = op4_minhash.WordHashes()
    sets = [op4_minhash.shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if op4_minhash.overlap_enough(sets[i], sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_near_groups_equal_brute_force(spark):
    rows = near_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.class_id for r in op4_minhash.near_duplicates(docs).collect()}
    assert got == brute_near(rows)


def test_buckets_with_several_components_lose_no_link(spark, monkeypatch):
    # Everything meets everything in one bucket: links must be found block by block.
    monkeypatch.setattr(op4_minhash, "bands", lambda s: np.zeros((len(s), 1), dtype=np.int64))
    monkeypatch.setattr(op4_minhash, "BLOCK", 30)
    rows = near_corpus(9)[:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.class_id for r in op4_minhash.near_duplicates(docs).collect()}
    assert got == brute_near(rows)


def test_signature_is_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        common = rng.integers(0, 1 << 62, 120).astype(np.uint64)
        a, b = rng.integers(1, 40, 120), rng.integers(1, 40, 120)
        a[rng.random(120) < 0.3] = 0
        sets = [(common[w > 0], w[w > 0]) for w in (a, b)]
        s = op4_minhash.signatures(sets)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_near_edge_rows(edge_docs, no_docs):
    got = sorted(((r.doc_id, r.class_id, r.group_size) for r in op4_minhash.near_duplicates(edge_docs).collect()), key=str)
    assert got == sorted([(1, 1, 3), (5, 1, 3), (5, 1, 3), (2, 2, 2), (3, 2, 2), (4, 4, 1), (None, None, 1), (6, 6, 1), (7, 7, 1), (8, 8, 1)], key=str)
    kept = op4_minhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 4, None, 6, 7, 8]))
    assert op4_minhash.near_duplicates(no_docs).collect() == [] and op4_minhash.drop_near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("share", [1, 4, 10_000])
def test_rows_meet_hot_and_other_keys_alike(spark, monkeypatch, share):
    from regpanel.llm import common
    monkeypatch.setattr(common, "HOT_SHARE", share)
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 10}") for i in range(300)], "i int, k string")
    side = rows.groupBy("k").agg(F.max("i").alias("m"), F.count(F.lit(1)).alias("_rows"))
    got = sorted((r.i, r.k, r.m) for r in common.joined_to_keys(rows, side, "k").collect())
    assert got == sorted((r.i, r.k, r.m) for r in rows.join(side, "k").collect()) and len(got) == 300
    assert common.joined_to_keys(rows.limit(0), side.limit(0), "k").collect() == []
