import hashlib

import numpy as np
import pytest
from regpanel.llm import op13_codes as c


def brute(rows, parts, entries, rounds, factor=256):
    """Codes, errors, errors per label and digest by plain Python over (id, vector, label)."""
    whole = [(i, [int(np.floor(factor * x)) for x in v], label) for i, v, label in rows]
    step = len(whole[0][1]) // parts
    cut = lambda v, p: v[p * step:(p + 1) * step]
    first = {}
    for i, v, _ in whole:
        first[i] = min(v, first.get(i, v))
    ids = sorted(first, key=lambda i: (i is None, i))[:entries]
    books = [[cut(first[i], p) for i in ids] for p in range(parts)]

    def assign():
        out = []
        for _, v, _ in whole:
            out.append([min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p])) for p in range(parts)])
        return out

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for k in range(len(ids)):
                own = [cut(v, p) for (_, v, _), a in zip(whole, near) if a[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    error = [sum(d for d, _ in a) for a in near]
    by_label = {}
    for (_, _, label), e in zip(whole, error):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in a), e, by_label[label], digest) for (i, _, label), a, e in zip(whole, near, error)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def check(spark, rows, pieces=5, **settings):
    df = spark.createDataFrame([(i, [float(x) for x in v], label, "x") for i, v, label in rows], "vec_id long, embedding array<double>, label int, code string")
    got = [tuple(r) for r in c.code_rows(*c.compress(df.repartition(pieces), **settings)).collect()]
    settings = {"parts": c.PARTS, "entries": c.ENTRIES, "rounds": c.ROUNDS} | settings
    assert ordered(got) == ordered(brute(rows, **settings))
    return got


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8), [None, 0, 0, 1][i % 4]) for i in range(120)]
    assert check(spark, rows, parts=4, entries=10, rounds=3) != check(spark, rows, parts=2, entries=7, rounds=0)


def test_chunks_do_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6), i % 3) for i in range(100)]
    once = check(spark, rows, parts=3, entries=8)
    monkeypatch.setattr(c, "CHUNK_ROWS", 7)
    assert ordered(check(spark, rows, pieces=2, parts=3, entries=8)) == ordered(once)


def test_ties_repeats_and_a_hot_label(spark):
    # Small whole numbers give equal distances; the codebook repeats entries; ids and rows repeat.
    rng = np.random.default_rng(3)
    rows = [(i // 2, rng.integers(-1, 2, size=4) / 256, 1 if i % 3 else None) for i in range(90)] + [(7, [0.0] * 4, 1)] * 50
    check(spark, rows, parts=2, entries=16)


def test_fewer_rows_than_entries(spark):
    check(spark, [(3, [0.5, -0.25], None), (None, [2.0, 1.0], None), (1, [0.1, 0.3], 4)], parts=2)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, -0.5], 1), (2, None, 1), (3, [0.0, 0.0], None), (4, [nan, 1.0], 1), (5, [-inf, 1.0], 1), (6, [None, 1.0], 1),
            (7, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], None), (8, [], 1), (9, [1e300, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [tuple(r) for r in c.code_rows(*c.compress(df, parts=2)).collect()]
    assert ordered(got) == ordered(brute([r for r in rows if r[0] in (0, 1, 3, None)], 2, 64, 2))
    assert c.code_rows(*c.compress(df.limit(0), parts=2)).collect() == []
    assert [r.label for r in c.compress(df, label=None, parts=2)[0].collect()] == [None] * 4
    with pytest.raises(ValueError):
        c.compress(df, parts=5)
