import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from regpanel.operators import intervals as iv
from regpanel.plans.panel import panelize, yearly_panel

D = dt.date


def test_next_known_fill_fixture(spark):
    # Null, null, A, null by date -> A, A, A, null
    df = spark.createDataFrame(
        [("t1", D(2020, 1, 1), None), ("t1", D(2020, 2, 1), None),
         ("t1", D(2020, 3, 1), "A"), ("t1", D(2020, 4, 1), None),
         ("t2", D(2020, 1, 1), "B")],
        "tin string, d date, reg string")
    for method in ("bucketed", "window"):
        out = iv.next_known_fill(df, "tin", ["d"], "reg", "filled", method=method)
        assert rows(out, "tin", "d", "filled") == [
            ("t1", D(2020, 1, 1), "A"), ("t1", D(2020, 2, 1), "A"),
            ("t1", D(2020, 3, 1), "A"), ("t1", D(2020, 4, 1), None),
            ("t2", D(2020, 1, 1), "B")]


def test_next_known_fill_hot_key_across_partitions(spark):
    # One key holds most rows, so the range partitioner splits it over many
    # partitions; nulls run across partition edges. Compare with the window.
    rnd = random.Random(7)
    data = []
    for i in range(4000):
        key = "hot" if i % 10 else f"k{i % 37}"
        val = None if rnd.random() < 0.9 else float(i)
        data.append((key, i, val))
    df = spark.createDataFrame(data, "k string, t long, v double").repartition(8)
    a = iv.next_known_fill(df, "k", ["t"], "v", "f", method="bucketed")
    b = iv.next_known_fill(df, "k", ["t"], "v", "f", method="window")
    assert rows(a, "k", "t", "f") == rows(b, "k", "t", "f")


def test_state_hull_is_hull_not_islands(spark):
    # A, B, A on d1<d2<d3 -> A[d1,d3], B[d2,d2]
    df = spark.createDataFrame(
        [("t", "A", D(2020, 1, 1), "x1"), ("t", "B", D(2020, 2, 1), "x2"),
         ("t", "A", D(2020, 3, 1), "x3")], "tin string, s string, d date, extra string")
    out = iv.state_hull(df, ["tin", "s"], "d", carry=["extra"])
    assert rows(out, "tin", "s", "extra", "start_date", "end_date") == [
        ("t", "A", "x1", D(2020, 1, 1), D(2020, 3, 1)),
        ("t", "B", "x2", D(2020, 2, 1), D(2020, 2, 1))]


def test_state_hull_null_keys_group_together(spark):
    df = spark.createDataFrame(
        [("t", None, D(2020, 1, 1)), ("t", None, D(2021, 1, 1))], "tin string, s string, d date")
    out = iv.state_hull(df, ["tin", "s"], "d", carry=[])
    assert out.count() == 1


def test_latest_revision(spark):
    # Two doc dates for one (tin, period): latest wins; a lone null-dated
    # row is kept; null loses against a dated revision.
    df = spark.createDataFrame(
        [("t1", D(2020, 12, 31), D(2021, 3, 1), 1.0), ("t1", D(2020, 12, 31), D(2021, 5, 1), 2.0),
         ("t1", D(2020, 12, 31), None, 9.0),
         ("t2", D(2020, 12, 31), None, 3.0)],
        "tin string, data_date date, doc_date date, revenue double")
    out = iv.latest_revision(df, ["tin", "data_date"], "doc_date", method="aggregate")
    win = iv.latest_revision_window(df, ["tin", "data_date"], "doc_date")
    expect = [("t1", 2.0), ("t2", 3.0)]
    assert rows(out, "tin", "revenue") == expect
    assert rows(win, "tin", "revenue") == expect


def test_hull_last_end_takes_end_of_last_start(spark):
    # [1,9] and [2,5] with the same key -> [1,5]
    df = spark.createDataFrame(
        [("k", D(2020, 1, 1), D(2020, 1, 9)), ("k", D(2020, 1, 2), D(2020, 1, 5))],
        "k string, start_date date, end_date date")
    out = iv.hull_last_end(df, ["k"], carry=[])
    assert rows(out) == [("k", D(2020, 1, 1), D(2020, 1, 5))]


def test_expand_years_cases(spark):
    # 2019-2021 -> 3 rows; same year -> 1; null end -> none; end before start -> none
    df = spark.createDataFrame(
        [("a", D(2019, 5, 1), D(2021, 2, 1)), ("b", D(2020, 1, 1), D(2020, 6, 1)),
         ("c", D(2020, 1, 1), None), ("d", D(2021, 1, 1), D(2019, 1, 1))],
        "tin string, start_date date, end_date date")
    out = iv.expand_years(df)
    assert rows(out, "tin", "year") == [("a", 2019), ("a", 2020), ("a", 2021), ("b", 2020)]


def test_panelize_attaches_facts_or_nulls(spark):
    # Years with and without facts
    ivs = spark.createDataFrame([("t", D(2019, 1, 1), D(2020, 12, 31))],
                                "tin string, start_date date, end_date date")
    rev = spark.createDataFrame([("t", 2019, 10.0)], "tin string, year int, revenue double")
    emp = spark.createDataFrame([("t", 2020, 5)], "tin string, year int, employees_count int")
    out = panelize(ivs, [rev, emp])
    assert rows(out, "year", "revenue", "employees_count") == [(2019, 10.0, None), (2020, None, 5)]


def test_yearly_panel_open_end_and_confidence(spark):
    # J9 + W5: open end runs to the last year; two overlapping records in one
    # year -> latest start kept, confidence 0.5
    ivs = spark.createDataFrame(
        [("t", 1, D(2019, 1, 1), None), ("t", 2, D(2020, 3, 1), D(2020, 9, 1)),
         ("u", 3, D(2018, 1, 1), D(2021, 6, 1))],
        "tin string, rid int, start_date date, end_date date")
    out = yearly_panel(ivs, tiebreak=["rid"])
    assert rows(out, "tin", "year", "rid", "confidence") == [
        ("t", 2019, 1, 1.0), ("t", 2020, 2, 0.5), ("t", 2021, 1, 1.0),
        ("u", 2018, 3, 1.0), ("u", 2019, 3, 1.0), ("u", 2020, 3, 1.0), ("u", 2021, 3, 1.0)]


@pytest.mark.parametrize("method", ["bucketed", "window"])
def test_next_known_fill_all_null_and_ties_free(spark, method):
    df = spark.createDataFrame([("x", i, None) for i in range(5)], "k string, t int, v string")
    out = iv.next_known_fill(df, "k", ["t"], "v", "f", method=method)
    assert out.filter(F.col("f").isNotNull()).count() == 0
