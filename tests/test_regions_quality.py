import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import rows
from regpanel.operators import quality, regions, scan


def _regions(spark):
    return spark.createDataFrame(
        [(0, "01", "Республика Адыгея", "Адыгея", "RU-AD"),
         (1, "77", "Москва", "Москва", "RU-MOW"),
         (2, "50", "Московская область", "Московская", "RU-MOS"),
         (3, "45", "Курганская область", "Курганская", "RU-KGN")],
        "_row int, code string, name string, short_name string, iso_code string")


def test_region_resolution_cases(spark):
    # Exact, short, by code 1 / 01, misspelt, unknown, null
    df = spark.createDataFrame(
        [(1, "москва"), (2, "Адыгея"), (3, "1"), (4, "01"), (5, "Курганскя обл"),
         (6, "Нарния"), (7, None), (8, "")], "id int, region string")
    words = ["область", "республика", " обл"]
    out = regions.normalize_regions(df, "region", _regions(spark), words, 80.0)
    got = {r["id"]: (r["region"], r["region_code"], r["region_iso_code"])
           for r in out.collect()}
    assert got[1] == ("Москва", "77", "RU-MOW")
    assert got[2] == ("Республика Адыгея", "01", "RU-AD")
    assert got[3] == got[4] == ("Республика Адыгея", "01", "RU-AD")
    assert got[5] == ("Курганская область", "45", "RU-KGN")
    assert got[6] == got[7] == got[8] == (None, None, None)
    assert out.count() == 8


def _sim(a, b):
    # reference edit similarity for the brute-force check
    m, n = len(a), len(b)
    d = list(range(n + 1))
    for i in range(1, m + 1):
        prev, d[0] = d[0], i
        for j in range(1, n + 1):
            cur = d[j]
            d[j] = min(d[j] + 1, d[j - 1] + 1, prev + (a[i - 1] != b[j - 1]))
            prev = cur
    L = max(m, n)
    return 100.0 if L == 0 else 100.0 * (1 - d[n] / L)


def test_bigram_blocking_equals_brute_force(spark):
    rnd = random.Random(3)
    alpha = "abcde"
    shorts = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 7))) for _ in range(25)]
    reg = spark.createDataFrame([(i, str(i + 1), s.upper(), s, f"X{i}")
                                 for i, s in enumerate(shorts)],
                                "_row int, code string, name string, short_name string, iso_code string")
    keys = []
    for s in shorts * 3:
        k = list(s)
        if k and rnd.random() < 0.7:
            k[rnd.randrange(len(k))] = rnd.choice(alpha)
        if rnd.random() < 0.3:
            k.append(rnd.choice(alpha))
        keys.append("x" + "".join(k))
    df = spark.createDataFrame([(k,) for k in set(keys)], "key string")
    got = dict(rows(regions.resolve_names(df, "key", reg, threshold=80.0)))
    for k in set(keys):
        lk = k.lower()
        exact = [i for i, s in enumerate(shorts) if s.upper().lower() == lk or s == lk]
        if exact:
            continue
        best, best_i = None, None
        seen = {}
        for i, s in enumerate(shorts):
            seen.setdefault(s, []).append(i)
        for s, idx in seen.items():
            sc = _sim(lk, s)
            if sc > 80 and (best is None or sc > best):
                best, best_i = sc, max(idx)
        assert got[k] == best_i, (k, got[k], best_i)


def test_spearman_ties_perfect_reversed(spark):
    # Ties -> average-rank value; perfect order -> 1; reversed -> -1
    data = [("perfect", float(i), float(i * 10)) for i in range(6)]
    data += [("reversed", float(i), float(-i)) for i in range(6)]
    ties = [(1.0, 2.0), (2.0, 2.0), (2.0, 3.0), (3.0, 1.0), (4.0, 5.0)]
    data += [("ties", x, y) for x, y in ties]
    df = spark.createDataFrame(data, "g string, x double, y double")
    got = dict((g, s) for g, s, _ in rows(quality.spearman(df, "x", "y", ["g"])))
    assert math.isclose(got["perfect"], 1.0)
    assert math.isclose(got["reversed"], -1.0)
    exp = pd.DataFrame(ties, columns=["x", "y"]).corr(method="spearman").iloc[0, 1]
    assert math.isclose(got["ties"], exp, rel_tol=1e-12)


def test_spearman_constant_or_single_group_is_null(spark):
    df = spark.createDataFrame([("c", 1.0, 5.0), ("c", 1.0, 6.0), ("one", 2.0, 3.0),
                                ("ok", 1.0, 1.0), ("ok", 2.0, 3.0)], "g string, x double, y double")
    got = {g: s for g, s, _ in quality.spearman(df, "x", "y", ["g"]).collect()}
    assert got["c"] is None and got["one"] is None and math.isclose(got["ok"], 1.0)


def test_spearman_matches_pandas_random(spark):
    rnd = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({"g": rnd.integers(0, 3, n), "x": rnd.integers(0, 50, n).astype(float),
                        "y": rnd.integers(0, 20, n).astype(float)})
    df = spark.createDataFrame(pdf).repartition(7)
    got = dict((g, s) for g, s, _ in rows(quality.spearman(df, "x", "y", ["g"])))
    for g, part in pdf.groupby("g"):
        exp = part[["x", "y"]].corr(method="spearman").iloc[0, 1]
        assert math.isclose(got[g], exp, rel_tol=1e-9)
    glob = quality.spearman(df, "x", "y").collect()[0]["spearman"]
    assert math.isclose(glob, pdf[["x", "y"]].corr(method="spearman").iloc[0, 1], rel_tol=1e-9)


def test_value_ranks_hot_group_split(spark):
    # One group with most of the distinct values: ranks must still be global.
    vals = [("hot", float(i)) for i in range(2000)] + [("cold", 1.0), ("cold", 1.0)]
    df = spark.createDataFrame(vals, "g string, v double").repartition(5)
    for kw in ({"buckets": 2}, {"buckets": 500}, {}):
        r = scan.value_ranks(df, ["g"], "v", **kw)
        got = {(g, v): b for g, v, _, b, _ in r.collect()}
        assert len(got) == 2001
        assert all(got[("hot", float(i))] == i for i in range(2000))
        assert got[("cold", 1.0)] == 0


def test_exact_quantiles_and_describe_match_pandas(spark):
    rnd = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rnd.integers(0, 2, 501), "v": rnd.normal(size=501).round(3)})
    df = spark.createDataFrame(pdf)
    d = quality.describe(df, "v", ["g"]).collect()
    got = {(r["g"], r["statistic"]): r["value"] for r in d}
    for g, part in pdf.groupby("g"):
        exp = part["v"].describe()
        for stat in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]:
            assert math.isclose(got[(g, stat)], exp[stat], rel_tol=1e-9, abs_tol=1e-12), stat


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (None, None)], "a int, b string")
    assert rows(quality.null_profile(df)) == [("a", 2, 3), ("b", 2, 3)]


def test_group_sums_drop_null_keys(spark):
    df = spark.createDataFrame([("r", 1), ("r", 2), (None, 5)], "k string, c long")
    assert rows(quality.group_sums(df, ["k"], ["c"])) == [("r", 3)]
    assert rows(quality.group_counts(df, ["k"])) == [("r", 2), (None, 1)]


def test_similarity_expression(spark):
    df = spark.createDataFrame([("abcde", "abcdf"), ("", "")], "a string, b string")
    from regpanel.functions import similarity
    got = [r[0] for r in df.select(similarity("a", "b")).collect()]
    assert got == [80.0, 100.0]
    assert F is not None
