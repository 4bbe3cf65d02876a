"""Property tests: the Spark operators agree with the pandas formulations
of the same rules on random small tables (pandas is how the source pipeline
expressed A2, A3, W3, J9/W5)."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from regpanel.operators import dedupe
from regpanel.operators import intervals as iv
from regpanel.plans.panel import yearly_panel

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.sampled_from(["a", "b", "c", None])
vals = st.integers(0, 5)


def _norm(seq):
    return sorted(seq, key=lambda t: tuple((x is None, str(x)) for x in t))


@SETTINGS
@given(st.lists(st.tuples(keys, keys, vals), min_size=1, max_size=25))
def test_drop_ambiguous_matches_pandas_keep_false(spark, data):
    pdf = pd.DataFrame(data, columns=["k1", "k2", "v"])
    exp = pdf.drop_duplicates(subset=["k1", "k2"], keep=False)
    exp = [tuple(None if pd.isna(x) else x for x in r) for r in exp.itertuples(index=False)]
    df = spark.createDataFrame(data, "k1 string, k2 string, v int")
    assert rows(dedupe.drop_ambiguous(df, ["k1", "k2"]), "k1", "k2", "v") == _norm(exp)


@SETTINGS
@given(st.lists(st.tuples(keys, vals), min_size=1, max_size=25))
def test_first_wins_matches_pandas_keep_first(spark, data):
    ordered = [(k, v, i) for i, (k, v) in enumerate(data)]
    pdf = pd.DataFrame(ordered, columns=["k", "v", "row"])
    exp = pdf.drop_duplicates(subset=["k"], keep="first")
    exp = [(None if pd.isna(k) else k, v) for k, v, _ in exp.itertuples(index=False)]
    df = spark.createDataFrame(ordered, "k string, v int, row int")
    got = dedupe.first_wins(df, ["k"], ["row"], ["v"])
    assert rows(got, "k", "v") == _norm(exp)


dates = st.one_of(st.none(), st.dates(dt.date(2019, 1, 1), dt.date(2021, 12, 31)))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["t1", "t2"]), st.sampled_from([2019, 2020]),
                          dates, vals), min_size=1, max_size=20, unique_by=lambda t: t))
def test_latest_revision_matches_pandas_sort_and_keep_first(spark, data):
    rows_ = [(t, y, d, v, i) for i, (t, y, d, v) in enumerate(data)]
    pdf = pd.DataFrame(rows_, columns=["tin", "period", "doc", "v", "uid"])
    pdf["doc"] = pd.to_datetime(pdf["doc"])
    exp = (pdf.sort_values(["doc", "uid"], ascending=[False, False], na_position="last",
                           kind="stable")
              .drop_duplicates(subset=["tin", "period"], keep="first"))
    exp = [(t, p, u) for t, p, u in exp[["tin", "period", "uid"]].itertuples(index=False)]
    df = spark.createDataFrame(rows_, "tin string, period int, doc date, v int, uid int")
    for method in ("window", "aggregate"):
        got = iv.latest_revision(df, ["tin", "period"], "doc", tiebreak=["uid"], method=method)
        assert rows(got, "tin", "period", "uid") == _norm(exp)


spans = st.tuples(st.dates(dt.date(2018, 1, 1), dt.date(2022, 12, 31)),
                  st.one_of(st.none(), st.integers(0, 900)))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["t1", "t2", "t3"]), spans), min_size=1, max_size=12))
def test_yearly_panel_matches_the_pandas_year_loop(spark, data):
    recs = []
    for i, (tin, (start, length)) in enumerate(data):
        end = None if length is None else start + dt.timedelta(days=length)
        recs.append((tin, i, start, end))
    pdf = pd.DataFrame(recs, columns=["tin", "rid", "start_date", "end_date"])
    pdf["start_date"] = pd.to_datetime(pdf["start_date"])
    pdf["end_date"] = pd.to_datetime(pdf["end_date"])
    first, last = pdf["start_date"].dt.year.min(), pdf["end_date"].dt.year.max()
    exp = []
    if not pd.isna(last):
        for year in range(first, int(last) + 1):
            lo, hi = pd.Timestamp(f"{year}-01-01"), pd.Timestamp(f"{year}-12-31")
            live = pdf.loc[~((pdf["start_date"] > hi) | (pdf["end_date"] < lo))]
            live = live.sort_values(["start_date", "rid"], kind="stable")
            sizes = live.groupby("tin").size()
            for tin, grp in live.groupby("tin"):
                exp.append((tin, year, int(grp.iloc[-1]["rid"]), 1 / sizes[tin]))
    df = spark.createDataFrame(recs, "tin string, rid int, start_date date, end_date date")
    got = yearly_panel(df, tiebreak=["rid"])
    assert rows(got, "tin", "year", "rid", "confidence") == _norm(exp)


@SETTINGS
@given(st.lists(spans, min_size=1, max_size=10))
def test_expand_years_matches_python_ranges(spark, data):
    recs = [(i, s, None if n is None else s + dt.timedelta(days=n)) for i, (s, n) in enumerate(data)]
    exp = [(i, y) for i, s, e in recs if e is not None for y in range(s.year, e.year + 1)]
    df = spark.createDataFrame(recs, "rid int, start_date date, end_date date")
    assert rows(iv.expand_years(df), "rid", "year") == _norm(exp)
