"""Degenerate inputs: empty dimensions, all-null columns, empty tables."""

from conftest import rows
from regpanel.operators import dedupe, keys, matching, quality, regions
from regpanel.operators import intervals as iv


def test_empty_standard_and_empty_dictionary(spark):
    addr = spark.createDataFrame([(1, "R", "S")], "aid int, region string, settlement_name string")
    std = spark.createDataFrame([], "id int, region string, settlement string")
    p = [matching.MatchPass("p", ["region", "settlement_name"], ["region", "settlement"], "s")]
    out = matching.waterfall_match(addr, {"s": std}, p)
    assert rows(out, "aid", "geo_id", "match_pass") == [(1, None, None)]
    empty = spark.createDataFrame([], "name string, name_full string")
    look = matching.dictionary_lookup(spark.createDataFrame([("г",)], "t string"), "t", empty)
    assert rows(look) == [(None,)]


def test_all_null_region_column(spark):
    reg = spark.createDataFrame([(0, "77", "Москва", "Москва", "RU-MOW")],
                                "_row int, code string, name string, short_name string, iso_code string")
    df = spark.createDataFrame([(1, None), (2, None)], "id int, region string")
    out = regions.normalize_regions(df, "region", reg)
    assert rows(out, "id", "region", "region_code") == [(1, None, None), (2, None, None)]


def test_empty_tables_pass_through(spark):
    e = spark.createDataFrame([], "tin string, s string, d date, v double")
    assert iv.state_hull(e, ["tin", "s"], "d", carry=["v"]).count() == 0
    assert iv.latest_revision(e, ["tin"], "d").count() == 0
    assert iv.next_known_fill(e, "tin", ["d"], "v", "f").count() == 0
    assert iv.next_known_fill(e, "tin", ["d"], "v", "f", method="bucketed").count() == 0
    assert dedupe.drop_ambiguous(e, ["tin"]).count() == 0
    assert quality.spearman(e, "v", "v", ["tin"]).count() == 0
    cls = spark.createDataFrame([], "group string, code string")
    assert rows(keys.expand_codes(cls, ["A", "01.10"])) == [("01.10",), ("A",)]
