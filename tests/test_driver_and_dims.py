import os
import tempfile

import duckdb
import pandas as pd
import pytest
from pyspark.sql import types as T

import __spark_entry__ as E
from regpanel.plans import driver
from conftest import rows
from regpanel.sources import csv, dims
from regpanel.sources.schemas import VALIDATION_ELEMENTS
from regpanel.sources.xml import parse_files

SMOKE = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["tin", "state", "start_date", "end_date", "year", "revenue", "n_orders"]


def test_every_query_has_an_oracle():
    # The library's own queries; corpus operators that SQL cannot express have tests instead.
    assert set(driver.QUERIES) == set(driver.ORACLE_SQL)
    assert len(driver.QUERIES) >= 40
    assert set(driver.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", ["panel_with_facts", "registry_hull", "waterfall_match",
                                  "region_exact_then_fuzzy", "spearman_by_group",
                                  "next_known_fill", "xml_documents", "describe_stats"])
def test_query_matches_duckdb_on_smoke_tables(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    sdf = E.queries()[name](spark, SMOKE)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    ddf = con.execute(E.oracle_sql()[name]).df()
    exp = sorted((tuple(_norm(None if pd.isna(x) else (x.item() if hasattr(x, "item") else x))
                        for x in r)
                  for r in ddf[cols].astype(object).itertuples(index=False)), key=repr)
    assert len(got) == len(exp)
    assert got == exp


def test_append_csv_and_whole_numbers(spark):
    out = os.path.join(tempfile.mkdtemp(dir="/tmp"), "append")
    df = spark.createDataFrame([(1, 2.6), (2, None)], "id int, v double")
    csv.append_csv(df, out, ["id", "v"])
    csv.append_csv(df, out, ["id", "v"])
    back = spark.read.options(header="true", nullValue="NA").schema("id int, v double").csv(out)
    assert back.count() == 4
    fmt = csv.format_whole_numbers(df, ["v"])
    assert rows(fmt) == [(1, "3"), (2, None)]


def test_dimension_loaders(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    with open(os.path.join(d, "abbr.csv"), "w") as f:
        f.write("type_id,fias_level,name,name_full\n1,1,г,Город\n2,1,п,Поселение\n3,1,п,Поселок\n")
    with open(os.path.join(d, "cities.csv"), "w") as f:
        f.write("address,region,area,area_type,city,city_type,settlement,settlement_type,oktmo,geo_lat,geo_lon\n"
                "x,Москва,,,Москва,г,,,45000000,55.7,37.6\n")
    with open(os.path.join(d, "extra.csv"), "w") as f:
        f.write('"region","city","city_type","geo_lat","geo_lon","oktmo"\n'
                '"Москва","Троицк","г","55.4","37.3","45931000"\n')
    ab = dims.load_abbreviations(spark, os.path.join(d, "abbr.csv"))
    order = [r["name_full"] for r in ab.orderBy("_row").collect()]
    assert order == ["Город", "Поселение", "Поселок"]
    c = dims.load_cities(spark, os.path.join(d, "cities.csv"), os.path.join(d, "extra.csv"))
    got = rows(c, "city", "geo_lat", "area")
    assert got == [("Москва", 55.7, None), ("Троицк", 55.4, None)]
    assert c.select("id").distinct().count() == 2
    r = dims.load_regions(spark)
    assert r.count() == 86
    assert r.filter("code = '77'").collect()[0]["name"] == "Москва"


def test_validation_projection_extract(spark):
    # The reduced projection is just another element map
    files = spark.createDataFrame([(
        "m", '<Файл><Документ ДатаСост="10.01.2020"><ОргВклМСП ИННЮЛ="1"/>'
             '<СведМН><Регион Наим="Москва"/></СведМН>'
             '<СвОКВЭД><СвОКВЭДОсн КодОКВЭД="01.10"/></СвОКВЭД></Документ></Файл>')],
        "member string, xml string")
    docs, _ = parse_files(files, VALIDATION_ELEMENTS)
    assert rows(docs) == [("m", "10.01.2020", None, "1", "Москва", "01.10")]
    assert T is not None
