import datetime as dt

from conftest import rows
from regpanel.operators import reshape
from regpanel.operators.matching import abbreviation_dictionary
from regpanel.plans.geocode import AREA_RULES, geocode

D = dt.date

REC_COLS = ("kind byte, category byte, tin string, reg_number string, first_name string, "
            "last_name string, patronymic string, org_name string, org_short_name string, "
            "region_code byte, region_name string, region_type string, district_name string, "
            "district_type string, city_name string, city_type string, settlement_name string, "
            "settlement_type string, activity_code_main string, start_date date, end_date date")


def _rec(tin, region, rtype, district=None, dtype=None, city=None, ctype=None,
         sett=None, stype=None, start=D(2020, 1, 1), end=D(2020, 12, 31)):
    return (1, 1, tin, "R" + tin, None, None, None, "ORG " + tin, None, None, region, rtype,
            district, dtype, city, ctype, sett, stype, "01.10", start, end)


def _dims(spark):
    regions = spark.createDataFrame(
        [(0, "77", "Москва", "Москва", "RU-MOW"),
         (1, "50", "Московская область", "Московская", "RU-MOS"),
         (2, "69", "Тверская область", "Тверская", "RU-TVE")],
        "_row int, code string, name string, short_name string, iso_code string")
    abbr = spark.createDataFrame(
        [("г", "Город", 0), ("обл", "Область", 1), ("р-н", "Район", 2), ("д", "Деревня", 3),
         ("п", "Поселок", 4)], "name string, name_full string, _row int")
    cities = spark.createDataFrame(
        [(1, "Москва", None, None, "Москва", "г", None, None, "45000000", 55.75, 37.62),
         (2, "Тверская", "Тверь", "г", None, None, None, None, "28701000", 56.86, 35.9),
         (3, "Московская", "Одинцовский", "р-н", "Одинцово", "г", None, None, "46755000", 55.67, 37.27)],
        "id long, region string, area string, area_type string, city string, city_type string, "
        "settlement string, settlement_type string, oktmo string, geo_lat double, geo_lon double")
    settlements = spark.createDataFrame(
        [(101, "Московская область", "Одинцовский", "Жуковка", "д", "46655000", 37.2, 55.7),
         (102, "Тверская область", "Калининский", "Эммаус", "п", "28620000", 35.8, 56.9)],
        "id long, region string, municipality string, settlement string, type string, "
        "oktmo string, longitude_dd double, latitude_dd double")
    return regions, abbreviation_dictionary(abbr), cities, settlements


def test_geocode_end_to_end(spark):
    regions, abbr, cities, settlements = _dims(spark)
    recs = spark.createDataFrame([
        _rec("1", "МОСКВА", "г"),
        _rec("2", "МОСКОВСКАЯ", "обл", "ОДИНЦОВСКИЙ", "р-н", None, None, "ЖУКОВКА", "д"),
        _rec("3", "ТВЕРСКАЯ", "обл", city="ТВЕРЬ", ctype="г",
             start=D(2019, 1, 1), end=D(2019, 12, 31)),
        _rec("3", "ТВЕРСКАЯ", "обл", city="ТВЕРЬ", ctype="гор",
             start=D(2020, 1, 1), end=D(2020, 6, 30)),
    ], REC_COLS)
    out = geocode(recs, cities, settlements, regions, abbr)
    got = {r["tin"]: r for r in out.collect()}
    assert out.count() == 3                      # tin 3's two intervals merged (W4)
    assert got["1"]["region"] == "Москва" and got["1"]["settlement"] == "Москва"   # P13
    assert got["1"]["region_iso_code"] == "RU-MOW" and got["1"]["oktmo"] is None
    assert got["2"]["region"] == "Московская область" and got["2"]["oktmo"] == "46655000"
    assert got["2"]["settlement"] == "Жуковка" and got["2"]["settlement_type"] == "д"
    assert got["3"]["region"] == "Тверская область" and got["3"]["settlement"] == "Тверь"
    assert got["3"]["settlement_type"] == "г" and got["3"]["area"] is None
    assert (got["3"]["start_date"], got["3"]["end_date"]) == (D(2019, 1, 1), D(2020, 6, 30))


def test_cities_standard_and_joint_geodata(spark):
    _, _, cities, settlements = _dims(spark)
    std = reshape.cities_standard(cities)
    assert rows(std, "id", "area", "city") == [
        (1, None, "Москва"), (2, "Тверь", None), (2, None, "Тверь"), (3, "Одинцовский", "Одинцово")]
    geo = reshape.joint_geodata(cities, settlements, AREA_RULES)
    got = {(r["type"], r["geo_id"]): r for r in geo.collect()}
    assert got[("c", 3)]["area"] == "Одинцовский район"
    assert got[("c", 2)]["area"] is None and got[("c", 2)]["settlement"] == "Тверь"
    assert got[("s", 101)]["settlement_type"] == "д" and got[("s", 101)]["lat"] == 55.7


def test_unpivot_pivot_union(spark):
    df = spark.createDataFrame([("a", 2019, 1), ("a", 2020, 2), ("b", 2019, 3)],
                               "k string, year int, n int")
    wide = reshape.to_wide(df, ["k"], "year", "n", values=[2019, 2020])
    assert rows(wide) == [("a", 1, 2), ("b", 3, None)]
    long = reshape.to_long(wide, ["k"], ["2019", "2020"], "year", "n")
    assert rows(long.dropna()) == [("a", "2019", 1), ("a", "2020", 2), ("b", "2019", 3)]
    u = reshape.union_all([df.select("k"), df.select("k", "n")])
    assert u.count() == 6 and set(u.columns) == {"k", "n"}
