import itertools
import os
import statistics
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from regpanel.operators.intervals import next_known_fill
from regpanel.operators.scan import order_bucket
from regpanel.plans import validation
from regpanel.plans.extract import extract
from regpanel.plans.pipeline import read_quarantine, run_extract, write_extract
from regpanel.sources import archive, csv, dims, xml
from regpanel.sources.schemas import VALIDATION_ELEMENTS


def scratch():
    return tempfile.mkdtemp(prefix="regpanel-files-", dir="/tmp")


@pytest.fixture
def splits(spark):
    """Sets the bytes of a split for the test, and 1 or many partitions with it."""
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


# ------------------------------------------------------------------ S13
def statistics_files():
    d = scratch()
    for i, (preamble, n) in enumerate([(2, 3), (0, 60), (7, 1), (1, 25)]):
        with open(os.path.join(d, f"t{i}.csv"), "w") as f:
            f.writelines(f"line {k} of a preamble\n" for k in range(preamble))
            f.write(",region,activity,2019,2020\n\n,,label,units,units\n")
            f.writelines(f'{k}," R{i} ""x"", {k} ",A{k % 3} ,{k}.5,{"" if k % 2 else k}\n' for k in range(n))
    return d


@pytest.mark.parametrize("size", [150, 400, 1 << 20])
def test_statistics_in_any_splits(spark, splits, size):
    # Headers and label lines fall on either side of a split; blank lines drop and are not counted.
    d = statistics_files()
    splits(size)
    got = csv.read_statistics_table(spark, d, ["region", "activity"], ["2019", "2020"]).orderBy("_row").collect()
    want, at = [], 0
    for i, (preamble, n) in enumerate([(2, 3), (0, 60), (7, 1), (1, 25)]):
        at += preamble + 2
        want += [(f'R{i} "x", {k}', f"A{k % 3}", k + 0.5, None if k % 2 else float(k), at + k) for k in range(n)]
        at += n
    assert [tuple(r) for r in got] == want


def test_a_statistics_file_without_header_raises(spark):
    d = statistics_files()
    with open(os.path.join(d, "t9.csv"), "w") as f:
        f.write("a,b,c,2019,2021\n")
    with pytest.raises(Exception, match="no header line"):
        csv.read_statistics_table(spark, d, ["region", "activity"], ["2019", "2020"]).collect()


# ------------------------------------------------------------------ S8
def test_running_ids_do_not_depend_on_partitions(spark, splits):
    base, more = scratch(), scratch()
    names = []
    # Files of unequal size: packing by size deals them out in another order than by name.
    for d, i, n in ((base, 0, 3), (base, 1, 200), (base, 2, 1), (base, 3, 40), (more, 0, 7), (more, 1, 90)):
        head = "region,area,city,geo_lat" if d == base else "geo_lat,city,region"
        with open(os.path.join(d, f"part-{i}.csv"), "w") as f:
            f.write(head + "\n")
            for k in range(n):
                name = f"{os.path.basename(d)}-{i}-{k}"
                names.append(name)
                f.write(f'r,"a, {k}",{name},{k}.5\n' if d == base else f"{k}.5,{name},r\n")
    seen = []
    for size in (1 << 30, 2500):
        splits(size)
        cities = dims.load_cities(spark, base, more)
        seen.append([(r.id, r.city) for r in cities.orderBy("id").collect()])
        assert cities.where("area is null").count() == 97
    assert seen[0] == list(enumerate(names)) and seen[0] == seen[1]


# ------------------------------------------------------------------ S7
def test_a_batch_is_appended_once(spark):
    out = os.path.join(scratch(), "table")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.DoubleType())])
    one = spark.createDataFrame([(1, 2.5, "x"), (2, None, "y")], "id int, v double, w string")
    two = spark.createDataFrame([(3, 0.5, "z")], "id int, v double, w string")
    assert csv.read_appended(spark, out, schema).collect() == []
    assert csv.append_csv(one, out, ["id", "v"], batch_id="b-1") is True
    assert csv.append_csv(one, out, ["id", "v"], batch_id="b-1") is False
    # An attempt that died: rows without a marker, not seen, and replaced by the retry.
    csv.write_csv(one.select("id", "v"), f"{out}/batch=b-2")
    assert rows(csv.read_appended(spark, out, schema)) == [(1, 2.5, "b-1"), (2, None, "b-1")]
    assert csv.append_csv(two, out, ["id", "v"], batch_id="b-2") and csv.append_csv(two.limit(0), out, ["id", "v"], batch_id="b-3")
    assert rows(csv.read_appended(spark, out, schema)) == [(1, 2.5, "b-1"), (2, None, "b-1"), (3, 0.5, "b-2")]
    assert csv.appended_batches(spark, out) == ["b-1", "b-2", "b-3"]
    with pytest.raises(ValueError):
        csv.append_csv(one, out, ["id"], batch_id="../x")


# ------------------------------------------------------------------ S14
def test_whole_numbers_as_c_prints_them(spark):
    values = [0.0, -0.0, 0.5, 1.5, 2.5, -0.5, -0.3, -2.5, 2.6, 1e15 + 0.5, 2.0 ** 53 + 2, -(2.0 ** 60), 2.0 ** 63, 2.0 ** 63 + 2048, 1e22, 1e23, -1.2345e30,
              2.0 ** 100 + 2.0 ** 60, 3.3e36, 9.9e15, 123456789012345678.0]
    values += [x * 2.0 ** e for x in (1.1, 3.7, -9.03) for e in range(40, 118, 7)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: r.v for r in csv.format_whole_numbers(df, ["v"]).collect()}
    assert got == {i: "%.0f" % v for i, v in enumerate(values)}
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert [r.v for r in csv.format_whole_numbers(odd, ["v"]).collect()] == [None, None, "inf", "-inf"]


# ------------------------------------------------------------------ S9
def test_inferred_types_keep_every_text(spark):
    d = scratch()
    docs = [('01.10', '7', '1.50', '2020-01-02', 'true', '1.5', '12345678901234567890', '0.10'), ('12.20', '-3', '20.25', '2021-12-31', 'false', '2', '5', '0.1'),
            ('46.10', '0', '3.00', '2021-01-01', 'true', '0.25', '6', '7')]
    with open(os.path.join(d, "a.xml"), "w") as f:
        f.write("<F>" + "".join('<D code="%s" n="%s"><M sum="%s" day="%s" flag="%s"/><M part="%s" big="%s"/><K mix="%s"/></D>' % x for x in docs) + "</F>")
    schema = xml.infer_xml_schema(spark, d, "D")
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert kinds == {"_code": "string", "_n": "bigint", "K": "struct<_mix:string>",
                     "M": "array<struct<_big:string,_day:date,_flag:boolean,_part:double,_sum:decimal(38,2)>>"}
    back = xml.read_xml_documents(spark, d, "D", schema)
    assert sorted(r[0] for r in back.select("_code").collect()) == ["01.10", "12.20", "46.10"]
    assert sorted(str(r[0]) for r in back.select(F.col("M._sum")[0]).collect()) == ["1.50", "20.25", "3.00"]


def test_inference_looks_at_rows_that_sampling_missed(spark):
    d = scratch()
    with open(os.path.join(d, "a.xml"), "w") as f:
        f.write("<F>" + "".join(f'<D code="{k}"/>' for k in range(10, 400)) + '<D code="007"/></F>')
    schema = xml.infer_xml_schema(spark, d, "D", sampling_ratio=0.1)
    assert schema["_code"].dataType == T.StringType()


# ------------------------------------------------------------------ S3
def test_slices_as_python_has_them(spark):
    bounds, steps = [None, 0, 2, 9, -1, -3, -9], [None, 2, -1, -3]
    cases = list(itertools.product(bounds, bounds, steps))
    for total in (0, 5):
        df = spark.range(total).withColumn("total", F.lit(total).cast("long"))
        flags = [archive.in_slice(F.col("id"), F.col("total"), *c).alias(f"c{i}") for i, c in enumerate(cases)]
        got = df.select("id", *flags).collect()
        for i, (a, b, c) in enumerate(cases):
            assert {r.id for r in got if r[f"c{i}"]} == set(list(range(total))[a:b:c]), (total, a, b, c)


def test_named_archives_and_stores(spark, monkeypatch):
    d = scratch()
    files = spark.createDataFrame([(f"{a}.zip", f"m{k:02d}.xml", f"<x>{a}{k}</x>") for a in "abc" for k in range(7)], "name string, member string, xml string")
    made = rows(archive.write_named_archives(files, d))
    assert made == [(f"{d}/{a}.zip", 7) for a in "abc"] and sorted(os.listdir(d)) == ["a.zip", "b.zip", "c.zip"]
    with zipfile.ZipFile(f"{d}/b.zip") as z:
        assert z.namelist() == [f"m{k:02d}.xml" for k in range(7)]
    got = archive.list_members(archive.list_archives(spark, d), start=-3, stop=None, step=2)
    assert [r[1] for r in rows(got)] == ["m04.xml", "m06.xml"] * 3
    with pytest.raises(ValueError):
        archive.list_members(archive.list_archives(spark, d), step=0)
    # Another store: the same calls through pyarrow's file systems.
    from pyarrow import fs
    monkeypatch.setattr(archive, "_store", lambda uri: (fs.LocalFileSystem(), uri.removeprefix("store:/")))
    with archive.created(f"store:/{d}/new/z.zip", 3) as out, zipfile.ZipFile(out, "w") as z:
        z.writestr("m", b"bytes")
    assert os.listdir(f"{d}/new") == ["z.zip"]
    with archive._open(f"store:/{d}/new/z.zip") as fh, zipfile.ZipFile(fh) as z:
        assert z.read("m") == b"bytes"
    with pytest.raises(RuntimeError), archive.created(f"{d}/half.zip", 1):
        raise RuntimeError
    assert "half.zip" not in os.listdir(d)


# ------------------------------------------------------------------ S12, C1
DOC = ('<Документ ДатаСост="10.01.2020"><ОргВклМСП НаимОрг="O" ИННЮЛ="{tin}"/><СведМН><Регион Наим="R"/></СведМН>'
       '<СвОКВЭД><СвОКВЭДОсн КодОКВЭД="01.10"/></СвОКВЭД></Документ>')


def test_validation_extract_reads_five_attributes(spark):
    d = scratch()
    files = spark.createDataFrame([(f"{y}.zip", "m.xml", f"<Файл>{DOC.format(tin=y)}</Файл>") for y in (2016, 2017, 2018)], "name string, member string, xml string")
    archive.write_named_archives(files, d).collect()
    docs = extract(spark, d, "smb", elements=VALIDATION_ELEMENTS, archive_names=["2016.zip", "2018.zip"]).documents
    assert rows(docs, *VALIDATION_ELEMENTS.values()) == [("10.01.2020", None, t, "R", "01.10") for t in ("2016", "2018")]
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "ИННЮЛ" in plan and "КодОКВЭД" in plan
    assert "НаимОрг" not in plan and "КатСубМСП" not in plan and "Фамилия" not in plan


def test_a_replay_removes_what_a_dead_run_left(spark):
    base = scratch()
    source, target = f"{base}/download/revexp", f"{base}/extract/revexp"
    doc = '<Файл><Документ ДатаСост="31.12.2019"><СведНП ИННЮЛ="{}"/></Документ></Файл>'

    def arrive(broken):
        files = [(f"{a}.zip", f"{a}{k}.xml", doc.format(k)[:-7] if broken else doc.format(k)) for a in "ab" for k in range(4)]
        archive.write_named_archives(spark.createDataFrame(files, "name string, member string, xml string"), source).collect()

    arrive(True)
    write_extract(extract(spark, source, "revexp"), target, "extract_revexp", {})
    assert read_quarantine(spark, base, "revexp").count() == 8
    arrive(False)
    run_extract(spark, base, None)
    assert read_quarantine(spark, base, "revexp").count() == 0 and spark.read.parquet(target).count() == 8
    arrive(True)                       # recorded archives are not read again
    run_extract(spark, base, None)
    assert spark.read.parquet(target).where("_status = 'ok'").count() == 8


# ------------------------------------------------------------------ C8
def test_summaries_are_built_when_asked_for(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("built too early")
    monkeypatch.setattr(validation, "describe", fail)
    stats = spark.createDataFrame([("r", 2019, "A", 1, 2, 0.5)], "region string, year int, group string, count_reestr int, count_stat int, norm_diff double")
    found = validation.summaries(stats)
    assert len(found) == 8 and found["by_group"] is found["by_group"]
    with pytest.raises(AssertionError):
        found["norm_diff"]


# ------------------------------------------------------------------ W1
def filled_by_hand(data, order):
    out, by_key = [], {}
    for r in sorted(data, key=order, reverse=True):
        by_key[r["k"]] = r["v"] if r["v"] is not None else by_key.get(r["k"])
        out.append((r["id"], by_key[r["k"]]))
    return sorted(out)


@pytest.mark.parametrize("order", [["s", "id"], ["tied", "id"], ["tied", "s", "id"], ["d", "s", "id"]])
def test_a_hot_key_is_cut_whatever_its_order(spark, order):
    data = [{"id": i, "k": "hot" if i % 3 else f"k{i % 11}", "s": f"{i * 7919 % 1009:04d}-{'x' * 70}{i % 5}", "tied": 1, "d": float(i % 4),
             "v": i if i % 5 == 0 else None} for i in range(3000)]
    df = spark.createDataFrame(data, "id long, k string, s string, tied int, d double, v long")
    got = next_known_fill(df, "k", order, "v", "out")
    assert sorted((r.id, r.out) for r in got.collect()) == filled_by_hand(data, lambda r: tuple(r[c] for c in order))
    sizes = [r["count"] for r in df.withColumn("b", order_bucket(df, order, 16)).groupBy("b").count().collect()]
    assert len(sizes) >= 12 and max(sizes) <= 3 * statistics.median(sizes), sizes


def test_order_buckets_are_monotone(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.lit("a")).when(F.col("id") % 17 != 0, F.hash("id").cast("string")).alias("s"),
                                  F.when(F.col("id") % 7 != 0, F.when(F.col("id") % 11 == 0, float("nan")).otherwise(F.col("id") * 1.0)).alias("d"))
    for order in (["s"], ["s", "id"], ["d"], ["d", "s"], ["id"]):
        b = [r.b for r in df.withColumn("b", order_bucket(df, order, 16)).orderBy(*order).collect()]
        assert b == sorted(b) and len(set(b)) > 8, order
    # All rows equal: one bucket; none: no rows.
    same = df.select(F.lit("x").alias("s"), F.lit(1).alias("i"))
    assert same.withColumn("b", order_bucket(same, ["s", "i"], 16)).select("b").distinct().count() == 1
    assert same.limit(0).withColumn("b", order_bucket(same.limit(0), ["s", "i"], 16)).collect() == []


# ------------------------------------------------------------------ the entry
@pytest.mark.parametrize("missing", ["zstandard", "regpanel.llm", "corpus_pipeline"])
def test_entry_stands_without_the_corpus_part(missing):
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.modules['{missing}'] = None\nimport __spark_entry__ as e\nfrom regpanel.plans import driver\n"
            "assert set(e.queries()) == set(driver.QUERIES) and set(e.oracle_sql()) == set(driver.ORACLE_SQL)")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


# ------------------------------------------------------------------ S3, members by their places
def test_members_are_read_by_their_places(spark):
    d = scratch()
    texts = {f"файл{i}.xml" if i % 3 else f"m{i}.xml": f'<?xml version="1.0" encoding="utf-8"?><x>{"ж" * 50 * i}</x>' for i in range(9)}
    with open(f"{d}/a.zip", "wb") as f:
        f.write(b"bytes before the archive")
        with zipfile.ZipFile(f, "w") as z:
            for i, (name, text) in enumerate(texts.items()):
                with z.open(zipfile.ZipInfo(name), "w", force_zip64=i == 4) as m:
                    m.write(text.encode())
                z.filelist[-1].comment = b"c" * i
                z.writestr(f"deflated-{name}", text, compress_type=zipfile.ZIP_DEFLATED)
            z.writestr("rare.xml", "<rare/>", compress_type=zipfile.ZIP_BZIP2)
    want = sorted([(n, t.split("?>")[1]) for n, t in texts.items()] + [("deflated-" + n, t.split("?>")[1]) for n, t in texts.items()] + [("rare.xml", "<rare/>")])
    listed = archive.list_members(archive.list_archives(spark, d)).where("member <> 'rare.xml'")
    assert rows(archive.scan_archives(spark, d), "member", "xml") == want
    assert rows(archive.read_members(archive.list_members(archive.list_archives(spark, d)).select("archive", "member")), "member", "xml") == want
    # The second phase goes to the members' own bytes: the directory is not read by every task again.
    kept = spark.createDataFrame(listed.collect(), listed.schema)
    with open(f"{d}/a.zip", "r+b") as f:
        at = f.read().index(b"PK\x01\x02")
        f.truncate(at)
    assert rows(archive.read_members(kept), "member", "xml") == [w for w in want if w[0] != "rare.xml"]


def test_an_archive_of_many_members(spark):
    d, n = scratch(), 70_000   # more than a directory without 64-bit fields counts
    files = spark.range(n).selectExpr("'a.zip' AS name", "format_string('m%06d.xml', id) AS member", "format_string('<x>%d</x>', id) AS xml")
    archive.write_named_archives(files, d).collect()
    with zipfile.ZipFile(f"{d}/a.zip") as z:
        assert z.testzip() is None and z.namelist() == [f"m{i:06d}.xml" for i in range(n)]
    got = archive.scan_archives(spark, d)
    assert got.selectExpr("sum(CAST(regexp_extract(xml, '[0-9]+', 0) AS LONG))", "count(DISTINCT member)").first()[:] == (n * (n - 1) // 2, n)


def test_a_broken_member_is_an_error(spark):
    d = scratch()
    with zipfile.ZipFile(f"{d}/a.zip", "w") as z:
        z.writestr("m.xml", "<x>whole</x>")
    with open(f"{d}/a.zip", "r+b") as f:
        f.seek(f.read().index(b"whole"))
        f.write(b"other")
    with pytest.raises(Exception, match="CRC"):
        archive.scan_archives(spark, d).collect()


# ------------------------------------------------------------------ S2 and S9, what runs per row
def test_attributes_are_read_without_lambdas(spark):
    elements = {"@a": "a", "B/@b": "b", "B/C/@c": "c"}
    docs = ['<D a="1"><B b="x"><C c="p"/><C/><C c="q"/></B></D>', '<D><B/><B b=""><C/></B></D>', "<D/>", '<D a=""><B b="y"/><B b="z"/></D>']
    files = spark.createDataFrame([(str(i), f"<F>{d}</F>") for i, d in enumerate(docs)], "member string, xml string")
    got, _ = xml.parse_files(files, elements, doc_tag="D")
    assert rows(got) == [("0", "1", "x", "p,q"), ("1", None, "", None), ("2", None, None, None), ("3", "", "y,z", None)]
    for made in (got, xml.parse_files_once(files, elements, doc_tag="D")):
        assert "lambda" not in made._jdf.queryExecution().toString()


def test_inference_guesses_no_types_and_tests_a_value_once(spark, monkeypatch):
    d = scratch()
    docs = ['<D n="1" f="1.50" g="2.5" z="01" t="2020-01-02" b="true"><E f="1.0"/><L v="1"/></D>',
            '<D n="2" f="2.25" z="2" t="2020-01-03" b="no"><E f="2.0"/><L v="2.5"/><L v="3"/></D>']
    with open(f"{d}/a.xml", "w") as f:
        f.write("<F>" + "".join(docs) + "</F>")
    checks, bit_and = [], F.bit_and
    monkeypatch.setattr(xml.F, "bit_and", lambda c: checks.append(c) or bit_and(c))
    got = xml.infer_xml_schema(spark, d, "D").simpleString()
    assert got == "struct<E:struct<_f:decimal(38,1)>,L:array<struct<_v:double>>,_b:string,_f:decimal(38,2),_g:decimal(38,1),_n:bigint,_t:date,_z:string>"
    assert len(checks) == 1   # one test for the values of all paths


def test_types_told_by_texts_are_those_of_inference(spark):
    d = scratch()
    docs = ['<D t="2020-01-01 10:00:00" u="2020-01-01 10:00:00.25" w="2020-01-01T10:00:00" b="TRUE" e="" z="-0" y="true"><a/><c>5</c><g/><n>null</n></D>',
            '<D t="2021-01-01 10:00:00" u="2020-01-01 10:00:00.5" e="5" z="0" y="false"><a><b>1</b></a><c>x</c><g> </g></D>']
    with open(f"{d}/a.xml", "w") as f:
        f.write("<F>" + "".join(docs) + "</F>")
    want = "struct<_b:string,_e:string,_t:timestamp,_u:timestamp,_w:string,_y:boolean,_z:string,a:struct<b:bigint>,c:string,g:string,n:string>"
    assert xml.infer_xml_schema(spark, d, "D").simpleString() == want
    assert xml.infer_xml_schema(spark, d, "D", mode="PERMISSIVE").simpleString() == want   # an option: Spark's guess comes first


# ------------------------------------------------------------------ W1, hot keys alone are cut
def test_only_hot_keys_are_cut_and_rows_are_not_joined(spark):
    from regpanel.operators.scan import hot_keys
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 WHEN id % 3 = 1 THEN NULL ELSE id % 500 END AS k", "3000 - id AS t",
                                      "CASE WHEN id % 7 = 0 THEN id END AS v")
    assert sorted(str(r._k.k) for r in hot_keys(df, ["k"], 16).collect()) == ["-1", "None"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = next_known_fill(df, "k", ["t"], "v", "f", buckets=16)
        assert rows(got) == rows(next_known_fill(df, "k", ["t"], "v", "f", method="window"))
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ------------------------------------------------------------------ C9, more than one archive a year
def test_archives_of_a_year_follow_the_keys(spark):
    from regpanel.plans.driver.files import _KEYS_PER_ARCHIVE, _archive
    keys = [0, _KEYS_PER_ARCHIVE - 1, _KEYS_PER_ARCHIVE, 11 * _KEYS_PER_ARCHIVE]
    df = spark.createDataFrame([(k,) for k in keys], "k long").withColumn("d", F.lit("1996-05-01").cast("date"))
    names = [r.n for r in df.orderBy("k").select(_archive("d", "k").alias("n")).collect()]
    assert names == sorted(names) and len(set(names)) == 3 and names[0] == names[1]
