import datetime as dt

from pyspark.sql import functions as F
import os
import tempfile

from regpanel.plans.pipeline import Dimensions, report, run_all
from regpanel.sources.archive import write_archives
from test_geocode_reshape import _dims

D = dt.date


def _smb(date, kind, body):
    return (f'<Документ ДатаСост="{date}" ВидСубМСП="{kind}" КатСубМСП="1" '
            f'ДатаВклМСП="01.08.2016">{body}<СвОКВЭД><СвОКВЭДОсн КодОКВЭД="01.10"/></СвОКВЭД>'
            '</Документ>')


ORG = ('<ОргВклМСП НаимОрг="ООО Ромашка" ИННЮЛ="7700000001" ОГРН="1027700000001"/>'
       '<СведМН КодРегион="77"><Регион Тип="г" Наим="Москва"/></СведМН>')
PERSON = ('<ИПВклМСП ИННФЛ="500000000001"{ogrn}><ФИОИП Фамилия="Иванов" Имя="Иван"/></ИПВклМСП>'
          '<СведМН КодРегион="50"><Регион Тип="обл" Наим="Московская"/>'
          '<Район Тип="р-н" Наим="Одинцовский"/><НаселПункт Тип="д" Наим="Жуковка"/></СведМН>')


def _file(fid, docs):
    return f'<?xml version="1.0" encoding="utf-8"?><Файл ИдФайл="{fid}" КолДок="{len(docs)}">{"".join(docs)}</Файл>'


def test_pipeline_end_to_end(spark):
    base = tempfile.mkdtemp(prefix="regpanel-pipe-", dir="/tmp")
    smb = [
        ("s1.xml", _file("S1", [_smb("10.01.2019", 1, ORG)])),
        ("s2.xml", _file("S2", [_smb("10.01.2020", 1, ORG),
                                _smb("10.01.2020", 2, PERSON.format(ogrn=""))])),
        ("s3.xml", _file("S3", [_smb("10.01.2021", 1, ORG),
                                _smb("10.01.2021", 2, PERSON.format(ogrn=' ОГРНИП="304500000000001"'))])),
        ("bad.xml", '<Файл ИдФайл="X"><Документ'),
    ]
    rev = lambda d, dd, r: ('<Документ ДатаСост="%s" ДатаДок="%s"><СведНП ИННЮЛ="7700000001"/>'  # noqa
                            '<СведДохРасх СумДоход="%s" СумРасход="1"/></Документ>' % (d, dd, r))
    revexp = [("r1.xml", _file("R1", [rev("31.12.2019", "01.03.2020", "10"),
                                      rev("31.12.2019", "01.05.2020", "20"),
                                      rev("31.12.2020", "01.03.2021", "30")]))]
    empl = [("e1.xml", _file("E1", ['<Документ ДатаСост="31.12.2020" ДатаДок="01.02.2021">'
                                    '<СведНП ИННЮЛ="7700000001"/><СведССЧР КолРаб="5"/></Документ>']))]
    for ds, files in (("smb", smb), ("revexp", revexp), ("empl", empl)):
        df = spark.createDataFrame(files, "member string, xml string")
        write_archives(df, os.path.join(base, "download", ds), 1, prefix=ds).collect()

    regions, _, cities, settlements = _dims(spark)
    abbr = spark.createDataFrame(
        [("г", "Город", 0), ("обл", "Область", 1), ("р-н", "Район", 2), ("д", "Деревня", 3)],
        "name string, name_full string, _row int")
    dims = Dimensions(cities, settlements, regions, abbr)
    metrics = {}
    panel = run_all(spark, base, dims, metrics=metrics)
    got = sorted((r["tin"], r["year"], r["revenue"], r["employees_count"], r["region"],
                  r["settlement"], r["reg_number"]) for r in panel.collect())
    assert got == [
        ("500000000001", 2020, None, None, "Московская область", "Жуковка", "304500000000001"),
        ("500000000001", 2021, None, None, "Московская область", "Жуковка", "304500000000001"),
        ("7700000001", 2019, 20.0, None, "Москва", "Москва", "1027700000001"),
        ("7700000001", 2020, 30.0, 5, "Москва", "Москва", "1027700000001"),
        ("7700000001", 2021, None, None, "Москва", "Москва", "1027700000001"),
    ]
    counts = report(metrics)
    assert counts["extract_smb"] == 5 and counts["quarantine_smb"] == 1
    assert counts["aggregate_smb"] == 2 and counts["panel"] == 5
    from regpanel.plans.pipeline import read_quarantine
    quarantine = read_quarantine(spark, base, "smb")
    assert [r["member"] for r in quarantine.collect()] == ["bad.xml"]
    assert os.path.isdir(os.path.join(base, "panel-csv"))
    # A second run with no new archives appends nothing to the extract.
    run_all(spark, base, dims)
    from regpanel.plans.pipeline import read_stage, run_extract
    assert read_stage(spark, os.path.join(base, "extract", "smb"), "smb").count() == 5
    # A run that died before recording its manifest re-reads those archives:
    # their partitions are replaced, nothing is duplicated.
    from regpanel.sources.archive import reset_manifest
    reset_manifest(spark, os.path.join(base, "extract", "smb-manifest"))
    run_extract(spark, base, dims)
    assert read_stage(spark, os.path.join(base, "extract", "smb"), "smb").count() == 5


def test_validation_statistics_side(spark):
    from regpanel.plans.validation import (compare, prepare_statistics, registry_by_region,
                                           registry_counts, summaries)
    from regpanel.sources.dims import load_regions
    regions = load_regions(spark)
    classifier = spark.createDataFrame(
        [("A", None, "Сельское хозяйство"), ("A", "01.10", "Посевы"),
         ("C", "", "Обрабатывающие производства"), ("C", "10.10", "Мясо")],
        "group string, code string, name string")
    stats = spark.createDataFrame(
        [("Город Москва столица", "Сельское хозяйство", 10.0, 12.0),
         ("Тверская область", "Обрабатывающие производства", 5.0, None),
         ("Тверская область", "Обрабатывающие производства", 99.0, 99.0),   # duplicate
         (" Архангельская область", "Сельское хозяйство", 7.0, 7.0)],
        "region_name string, activity string, `2019` double, `2020` double"
    ).withColumn("_row", F.monotonically_increasing_id())
    st = prepare_statistics(stats, classifier, regions, ["2019", "2020"],
                            manual_fixes={"Город Москва столица": "Москва"},
                            exclude=[" Архангельская область"])
    got = sorted((r["region"], r["group"], r["year"], r["count_stat"]) for r in st.collect())
    assert got == [("Москва", "A", 2019, 10.0), ("Москва", "A", 2020, 12.0),
                   ("Тверская область", "C", 2019, 5.0), ("Тверская область", "C", 2020, 0.0)]
    snaps = spark.createDataFrame(
        [("МОСКВА", "1", D(2019, 5, 1), "01.10"), ("МОСКВА", "2", D(2019, 5, 1), "01.10"),
         ("МОСКВА", "2", D(2019, 6, 1), "01.10"), ("ТВЕРСКАЯ ОБЛ", "3", D(2019, 1, 1), "10.10")],
        "region_name string, tin string, data_date date, activity_code_main string")
    reg = registry_by_region(registry_counts(snaps), classifier, regions)
    assert sorted(tuple(r) for r in reg.collect()) == [
        ("Москва", 2019, "A", 2), ("Тверская область", 2019, "C", 1)]
    m = compare(reg, st.filter("count_stat is not null")
                     .withColumn("count_stat", F.col("count_stat").cast("long")))
    assert sorted((r["region"], r["norm_diff"]) for r in m.collect()) == [
        ("Москва", (2 - 10) / 12), ("Тверская область", (1 - 5) / 6)]
    assert set(summaries(m)) >= {"overall", "by_group", "norm_diff"}
    from regpanel.plans.validation import run_validation
    snaps2 = snaps.withColumnRenamed("tin", "org_tin").withColumn("ind_tin", F.lit(None).cast("string"))
    stats2 = stats.withColumn("region_name", F.when(
        F.col("region_name") == "Город Москва столица",
        "Город Москва столица Российской Федерации город федерального значения")
        .otherwise(F.col("region_name")))
    res = run_validation(snaps2, stats2, classifier, regions, ["2019", "2020"])
    assert res["table"].count() == 2 and res["long"].count() == 4


def test_aggregate_reads_csv_extracts(spark):
    # Extracts written earlier as data-*.csv (dd.MM.yyyy dates) are accepted.
    import os
    import tempfile

    from regpanel.plans.pipeline import run_aggregate
    base = tempfile.mkdtemp(prefix="regpanel-csvx-", dir="/tmp")
    os.makedirs(os.path.join(base, "extract", "smb"))
    os.makedirs(os.path.join(base, "extract", "revexp"))
    with open(os.path.join(base, "extract", "smb", "data-1.csv"), "w") as f:
        f.write("kind,category,reestr_date,data_date,ind_tin,ind_number,first_name,last_name,"
                "patronymic,org_name,org_short_name,org_tin,org_number,region_code,region_name,"
                "region_type,district_name,district_type,city_name,city_type,settlement_name,"
                "settlement_type,activity_code_main,file_id,doc_cnt\n"
                "1,1,01.08.2016,10.01.2019,,,,,,\"ООО \"\"Р\"\"\",,77,1027,77,Москва,г,,,,,,,01.10,F,1\n"
                "1,1,01.08.2016,10.01.2020,,,,,,\"ООО \"\"Р\"\"\",,77,1027,77,Москва,г,,,,,,,01.10,F,1\n")
    with open(os.path.join(base, "extract", "revexp", "data-1.csv"), "w") as f:
        f.write("org_tin,revenue,expenditure,data_date,doc_date\n77,10.5,1,31.12.2019,01.03.2020\n")
    run_aggregate(spark, base)
    hull = spark.read.parquet(os.path.join(base, "aggregate", "smb")).collect()
    assert [(r["tin"], r["org_name"], r["start_date"], r["end_date"]) for r in hull] == [
        ("0000000077", 'ООО "Р"', D(2019, 1, 10), D(2020, 1, 10))]
    rev = spark.read.parquet(os.path.join(base, "aggregate", "revexp")).collect()
    assert [(r["tin"], r["year"], r["revenue"]) for r in rev] == [("0000000077", 2019, 10.5)]


def test_cli_runs_all_stages(spark, capsys):
    import json
    import os
    import tempfile

    from regpanel.__main__ import main
    base = tempfile.mkdtemp(prefix="regpanel-cli-", dir="/tmp")
    files = spark.createDataFrame([("s1.xml", _file("S1", [_smb("10.01.2019", 1, ORG)]))],
                                  "member string, xml string")
    write_archives(files, os.path.join(base, "download", "smb"), 1, prefix="smb").collect()
    d = os.path.join(base, "dims")
    os.makedirs(d)
    with open(os.path.join(d, "cities.csv"), "w") as f:
        f.write("region,area,area_type,city,city_type,settlement,settlement_type,oktmo,geo_lat,geo_lon\n"
                "Москва,,,Москва,г,,,45000000,55.75,37.62\n")
    with open(os.path.join(d, "settlements.csv"), "w") as f:
        f.write("id,region,municipality,settlement,type,oktmo,longitude_dd,latitude_dd\n"
                "1,Тверская область,Калининский,Эммаус,п,28620000,35.8,56.9\n")
    with open(os.path.join(d, "abbr.csv"), "w") as f:
        f.write("type_id,fias_level,name,name_full\n1,1,г,Город\n")
    main(["all", "--base", base, "--cities", os.path.join(d, "cities.csv"),
          "--settlements", os.path.join(d, "settlements.csv"), "--abbr", os.path.join(d, "abbr.csv")])
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts["extract_smb"] == 1 and counts["panel"] == 1
    panel = spark.read.parquet(os.path.join(base, "panel")).collect()
    assert panel[0]["region"] == "Москва" and panel[0]["settlement"] == "Москва"
    assert panel[0]["year"] == 2019
