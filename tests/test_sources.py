import datetime as dt
import os
import tempfile
import uuid

from pyspark.sql import types as T

from conftest import rows
from regpanel.plans.extract import extract
from regpanel.sources import archive, csv, links, xml
from regpanel.sources.schemas import ELEMENTS


def _scratch():
    return tempfile.mkdtemp(prefix="regpanel-src-", dir="/tmp")


SMB_DOC = ('<Документ ДатаСост="10.01.2020" ВидСубМСП="1" КатСубМСП="1" ДатаВклМСП="01.08.2016">'
           '<ОргВклМСП НаимОрг="ООО Ромашка" ИННЮЛ="7700000001" ОГРН="1027700000001"/>'
           '<СведМН КодРегион="77"><Регион Тип="г" Наим="Москва"/></СведМН>'
           '<СвОКВЭД><СвОКВЭДОсн КодОКВЭД="01.10"/></СвОКВЭД></Документ>')


def test_multi_valued_paths_and_quarantine(spark):
    # Attribute absent, once, twice; malformed member; leading-zero code
    files = spark.createDataFrame([
        ("ok.xml", '<Файл ИдФайл="F1" КолДок="2">'
                   '<Документ ДатаСост="01.02.2020"><A><B c="01.10"/></A></Документ>'
                   '<Документ ДатаСост="02.02.2020"><A><B c="x"/><B c="y"/></A><A><B c="z"/></A></Документ>'
                   '</Файл>'),
        ("empty.xml", '<Файл ИдФайл="F2" КолДок="0"></Файл>'),
        ("bad.xml", '<Файл ИдФайл="F3" КолДок="1"><Документ ДатаСост="01.02.2020">'),
    ], "member string, xml string")
    paths = {"@ДатаСост": "d", "A/B/@c": "codes", "A/@missing": "m"}
    docs, bad = xml.parse_files(files, paths, root_attrs={"ИдФайл": "file_id"})
    assert rows(docs, "member", "d", "codes", "m", "file_id") == [
        ("ok.xml", "01.02.2020", "01.10", None, "F1"),
        ("ok.xml", "02.02.2020", "x,y,z", None, "F1")]
    assert rows(bad, "member") == [("bad.xml",)]


def test_apply_types_bad_value_is_null(spark):
    df = spark.createDataFrame([("1", "01.02.2020", "zz")], "kind string, data_date string, n string")
    schema = T.StructType([T.StructField("kind", T.ByteType()),
                           T.StructField("data_date", T.DateType()),
                           T.StructField("n", T.IntegerType())])
    out = xml.apply_types(df, schema).collect()[0]
    assert out["kind"] == 1 and out["data_date"] == dt.date(2020, 2, 1) and out["n"] is None


def test_csv_roundtrip_nulls_quotes_separators(spark):
    # Null, embedded quote and separator survive the round trip
    schema = T.StructType([T.StructField("id", T.IntegerType()),
                           T.StructField("name", T.StringType()),
                           T.StructField("d", T.DateType())])
    df = spark.createDataFrame([(1, 'a "q"; b, c', dt.date(2020, 1, 2)), (2, None, None)], schema)
    out = os.path.join(_scratch(), "csv")
    csv.write_csv(df, out, sep=";")
    back = csv.read_snapshots(spark, out, schema, glob="*.csv", sep=";")
    assert rows(back) == rows(df)
    assert csv.read_snapshots(spark, os.path.join(out, "nope"), schema) is None
    assert csv.read_snapshots(spark, out + "/x.txt", schema) is None


def test_zip_scan_and_incremental_manifest(spark):
    # S3 + S4: the second run with one new archive reads only the new one
    base = _scratch()
    arch, manifest = os.path.join(base, "zips"), os.path.join(base, "manifest")
    first = spark.createDataFrame(
        [(f"m{i}.xml", f'<?xml version="1.0" encoding="utf-8"?><Файл ИдФайл="F{i}">{SMB_DOC}</Файл>')
         for i in range(6)], "member string, xml string")
    archive.write_archives(first, arch, 2, prefix="a").collect()
    run1 = extract(spark, arch, "smb", manifest_path=manifest)
    assert run1.documents.count() == 6
    archive.record_ingested(run1.archives, manifest)
    second = spark.createDataFrame(
        [("n0.xml", f'<Файл ИдФайл="N0">{SMB_DOC}</Файл>'), ("skip.txt", "<Файл/>")],
        "member string, xml string")
    archive.write_archives(second, arch, 1, prefix="b").collect()
    run2 = extract(spark, arch, "smb", manifest_path=manifest)
    got = run2.documents.collect()
    assert [r["member"] for r in got] == ["n0.xml"]
    r = got[0]
    assert r["file_id"] == "N0" and r["activity_code_main"] == "01.10"
    assert r["kind"] == 1 and r["data_date"] == dt.date(2020, 1, 10) and r["region_code"] == 77
    # P3 inside extraction: the code filter keeps exact members of the set
    cls = spark.createDataFrame([("A", "01.10"), ("C", "10.10")], "group string, code string")
    assert extract(spark, arch, "smb", classifier=cls, codes=["C"]).documents.count() == 0
    # clearing resets the manifest: everything is new again
    archive.reset_manifest(spark, manifest)
    assert extract(spark, arch, "smb", manifest_path=manifest).documents.count() == 7
    assert list(ELEMENTS["smb"].values())[0] == "kind"


def test_decode_by_declaration():
    raw = '<?xml version="1.0" encoding="windows-1251"?><a b="Ёж"/>'.encode("cp1251")
    assert archive.decode_xml(raw) == '<a b="Ёж"/>'
    assert archive.decode_xml('<a b="ж"/>'.encode()) == '<a b="ж"/>'


def test_links_and_new_links(spark):
    pages = spark.createDataFrame(
        [(1, '<a href="http://x/y/data-1.zip">1</a><a href="http://x/y/data-2.zip">2</a>'),
         (2, '<p><a href="/rel/data-2.zip">x</a></p>')], "page_id long, html string")
    lk = links.page_links(pages)
    assert rows(lk, "page_id", "name") == [(1, "data-1.zip"), (1, "data-2.zip"), (2, "data-2.zip")]
    have = spark.createDataFrame([("data-2.zip",)], "name string")
    assert rows(links.new_links(lk, have), "name") == [("data-1.zip",)]


def test_statistics_table_reader(spark):
    path = os.path.join(_scratch(), f"stats-{uuid.uuid4().hex}.csv")
    with open(path, "w") as f:
        f.write("Title line\nsecond preamble\n,region,activity,2019,2020\n,,,units,units\n"
                "1, Москва ,Торговля ,10,11\n2,Тверь,Торговля,3,\n")
    out = csv.read_statistics_table(spark, path, ["region_name", "activity"], ["2019", "2020"])
    assert rows(out.drop("_row")) == [("Москва", "Торговля", 10.0, 11.0),
                                      ("Тверь", "Торговля", 3.0, None)]


def test_validation_extract_from_picked_archives(spark):
    # Reduced projection over a hand-picked list of archives
    from regpanel.sources.schemas import VALIDATION_ELEMENTS
    base = _scratch()
    files = spark.createDataFrame([(f"m{i}.xml", f"<Файл>{SMB_DOC}</Файл>") for i in range(4)],
                                  "member string, xml string")
    archive.write_archives(files, base, 2, prefix="snap").collect()
    names = sorted(os.listdir(base))
    picked = [n for n in names if n.endswith(".zip")][:1]
    ex = extract(spark, base, "smb", elements=VALIDATION_ELEMENTS, archive_names=picked)
    got = ex.documents.collect()
    assert got and set(got[0].asDict()) == {"archive", "member", *VALIDATION_ELEMENTS.values(),
                                            "file_id", "doc_cnt"}
    assert all(r["archive"].endswith(picked[0]) for r in got)


def test_read_snapshots_empty_folder_is_none(spark):
    d = _scratch()
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("x")
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert csv.read_snapshots(spark, d, schema) is None
    with open(os.path.join(d, "data-1.csv"), "w") as f:
        f.write("a\nNA\nx\n")
    assert rows(csv.read_snapshots(spark, d, schema)) == [("x",), (None,)]


def test_member_slice(spark):
    base = _scratch()
    files = spark.createDataFrame([(f"m{i:02d}.xml", f"<Файл>{SMB_DOC}</Файл>") for i in range(10)],
                                  "member string, xml string")
    archive.write_archives(files, base, 1, prefix="one").collect()
    ex = extract(spark, base, "smb", member_slice=(1, 8, 3))
    members = sorted(r["member"] for r in ex.documents.select("member").collect())
    with __import__("zipfile").ZipFile(os.path.join(base, "one-00000.zip")) as z:
        names = [n for n in z.namelist() if "xml" in n][1:8:3]
    assert members == sorted(names) and len(members) == 3


def test_generated_files_grow_with_the_table(spark, monkeypatch):
    from regpanel.plans.driver import sources
    sf_dir = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    monkeypatch.setattr(sources, "_ROWS_PER_FILE", n // 9)
    scratch = _scratch()
    monkeypatch.setattr(sources, "_scratch", lambda spark, name: os.path.join(scratch, name))
    assert sources.xml_file_source_q(spark, sf_dir).count() == n
    assert len([f for f in os.listdir(os.path.join(scratch, "xml-files")) if f.endswith(".xml")]) >= 9
    assert sources.zip_scan_q(spark, sf_dir).count() == n
    assert len(os.listdir(os.path.join(scratch, "zip-scan"))) >= 9
