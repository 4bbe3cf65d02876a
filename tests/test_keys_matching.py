import pytest
from pyspark.sql import functions as F

from conftest import rows
from regpanel.operators import dedupe, keys, matching


def test_exclude_substrings_drops_match_and_null(spark):
    # Matching any-case, non-matching, null -> only the non-matching row
    df = spark.createDataFrame([("Республика Крым",), ("Москва",), (None,)], "region_name string")
    out = keys.exclude_substrings(df, "region_name", ["КРЫМ"])
    assert rows(out) == [("Москва",)]
    kept = keys.exclude_substrings(df, "region_name", ["КРЫМ"], keep_null=True)
    assert rows(kept) == [("Москва",), (None,)]


def test_entity_key_padding_truncation_and_priority(spark):
    # P6 + P7
    df = spark.createDataFrame(
        [("1", None, "77", None, "O1"), ("2", "123", "1234567890", "P2", "O2"),
         ("3", None, "123456789012", None, None)],
        "id string, ind_tin string, org_tin string, ind_number string, org_number string")
    out = keys.entity_key(df, "ind_tin", "org_tin", person_reg="ind_number", org_reg="org_number")
    assert rows(out, "id", "tin", "reg_number") == [
        ("1", "0000000077", "O1"), ("2", "000000000123", "P2"), ("3", "1234567890", None)]


def test_expand_codes_group_prefix_unknown_none(spark):
    # Group letter, prefix, unknown code, none
    cls = spark.createDataFrame(
        [("A", "01.10"), ("A", "01.20"), ("C", "10.10"), ("C", "10.20"), ("C", ""), ("C", None)],
        "group string, code string")
    got = lambda codes: sorted(r[0] for r in keys.expand_codes(cls, codes).collect())  # noqa
    assert got(["A"]) == ["01.10", "01.20"]
    assert got(["10.1"]) == ["10.10"]
    assert got(["99.99"]) == ["99.99"]
    assert got(["AB"]) == ["AB"]          # not a single letter: a (failed) prefix
    data = spark.createDataFrame([("01.10",), ("10.20",), ("55",)], "code string")
    assert keys.filter_by_codes(data, "code", cls, None).count() == 3
    assert rows(keys.filter_by_codes(data, "code", cls, ["A"])) == [("01.10",)]


def test_fill_federal_and_overrides(spark):
    df = spark.createDataFrame([("Москва", None), ("Москва", "Зеленоград"), ("Тверь", None)],
                               "region string, settlement string")
    out = keys.fill_when_null_and_in(df, "settlement", "region", ["Москва"])
    assert rows(out) == [("Москва", "Зеленоград"), ("Москва", "Москва"), ("Тверь", None)]
    fx = keys.override_values(df, "region", "settlement", {"Тверь": "X"})
    assert ("Тверь", "X") in rows(fx)


def test_normalized_difference_zero_denominator(spark):
    df = spark.createDataFrame([(3, 1), (0, 0)], "a long, b long")
    out = df.select(keys.normalized_difference("a", "b").alias("d"))
    assert rows(out) == [(0.5,), (None,)]


def test_first_wins_and_abbreviation_dictionary(spark):
    # A2: same short name with two expansions at different rows -> first row wins
    abbr = spark.createDataFrame(
        [("п", "Поселение", 0), ("г", "Город", 1), ("п", "Поселок", 2)],
        "name string, name_full string, _row int")
    d = matching.abbreviation_dictionary(abbr)
    m = dict(rows(d))
    assert m["П"] == "ПОСЕЛЕНИЕ"
    assert m["П."] == "ПОСЕЛЕНИЕ"      # dotted variant
    assert m["ГОРОД"] == "ГОРОД"       # full -> full
    # Known, dotted, full-name, unknown type
    data = spark.createDataFrame([(1, "г"), (2, "г."), (3, "Город"), (4, "xyz")],
                                 "id int, t string")
    out = matching.dictionary_lookup(data, "t", d)
    assert rows(out) == [(1, "ГОРОД"), (2, "ГОРОД"), (3, "ГОРОД"), (4, None)]


def test_drop_ambiguous_keeps_unique_and_null_key(spark):
    # A3: key once, key twice, null key once
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, v int")
    assert rows(dedupe.drop_ambiguous(df, ["k"])) == [("a", 1), (None, 4)]


def test_waterfall_cases(spark):
    # Hit in pass 1; hit only in a later pass; both sides null in a key
    # part; ambiguous key; 2-column key with null
    std = spark.createDataFrame(
        [(10, "R", "D1", "S1"), (11, "R", None, "S2"), (12, "R", "D3", "S3"),
         (13, "R", "D3", "S3"), (14, "R", "D9", "S4"), (15, "R", "D8", None)],
        "id int, region string, municipality string, settlement string")
    addr = spark.createDataFrame(
        [(1, "R", "D1", "S1"), (2, "R", "DX", "S4"), (3, "R", None, "S2"),
         (4, "R", "D3", "S3"), (5, "R", "DX", None)],
        "aid int, region string, district string, settlement_name string")
    passes = [
        matching.MatchPass("all", ["region", "district", "settlement_name"],
                           ["region", "municipality", "settlement"], "s"),
        matching.MatchPass("settlement", ["region", "settlement_name"],
                           ["region", "settlement"], "s"),
    ]
    out = matching.waterfall_match(addr, {"s": std}, passes)
    got = rows(out, "aid", "geo_id", "match_pass")
    assert got == [(1, 10, 1), (2, 14, 2), (3, 11, 1), (4, None, None), (5, None, None)]
    stats = rows(matching.match_stats(out))
    assert stats == [(1, 2), (2, 1), (None, 2)]


def test_unique_build_side_fails_on_duplicates(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception):
        matching.attach_checked(left, right, ["k"]).collect()
    ok = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(matching.attach_checked(left, ok, ["k"])) == [(1, "a")]
    assert rows(matching.uniqueness_violations(right, ["k"])) == [(1, 2)]


def test_name_and_type_composition(spark):
    # P10: null name, null type, prepend type, other type
    from regpanel.functions import join_area_and_type, join_name_and_type
    df = spark.createDataFrame([(None, "г"), ("Тверь", None), ("Тверь", "Город"), ("Тверь", "обл")],
                               "n string, t string")
    got = [r[0] for r in df.select(join_name_and_type("n", "t", ["Город"])).collect()]
    assert got == [None, None, "Город Тверь", "Тверь обл"]
    shipped = [r[0] for r in df.select(join_name_and_type("n", "t")).collect()]
    assert shipped[2] == "Тверь Город"          # default: type appended (shipped behaviour)
    # г, р-н, у, other; null either side
    rules = [("г", "Город ", ""), ("р-н", "", " район"), ("у", "", " улус")]
    a = spark.createDataFrame([("X", "г"), ("X", "р-н"), ("X", "у"), ("X", "п"), (None, "г"), ("X", None)],
                              "a string, t string")
    got = [r[0] for r in a.select(join_area_and_type("a", "t", rules)).collect()]
    assert got == ["Город X", "X район", "X улус", "X", None, None]


def test_facts_only_for_legal_entities(spark):
    # J1 + P9: facts for kind 1, kind 2, unknown tin -> kind 1 only
    from regpanel.plans.registry import aggregate_facts
    import datetime as dt
    registry = spark.createDataFrame([("0000000001", 1), ("0000000002", 2)], "tin string, kind int")
    facts = spark.createDataFrame(
        [("1", dt.date(2020, 12, 31), dt.date(2021, 3, 1), 5.0),
         ("2", dt.date(2020, 12, 31), dt.date(2021, 3, 1), 6.0),
         ("3", dt.date(2020, 12, 31), dt.date(2021, 3, 1), 7.0)],
        "org_tin string, data_date date, doc_date date, revenue double")
    out = aggregate_facts(facts, ["revenue"], registry)
    assert rows(out) == [("0000000001", 2020, 5.0)]
