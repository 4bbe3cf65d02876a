"""Source and sink queries (S1-S6, S9-S11, streaming S4)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .common import _scratch, iso_date, register, table


# ------------------------------------------------------------ S10 / S11 / F11
_LINKS_SQL = """
l AS (SELECT page_id, link, string_split(link, '/')[-1] AS name FROM (
        SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link
        FROM pages))"""


@register("page_links", f"""
WITH {_LINKS_SQL}
SELECT page_id, link, name FROM l
""")
def page_links_q(spark, sf_dir):
    """S10 + F11: every anchor target of every page, with its file name."""
    from ...sources.links import page_links
    return page_links(table(spark, sf_dir, "pages"))


@register("new_links", f"""
WITH {_LINKS_SQL},
have AS (SELECT DISTINCT l.name FROM l JOIN pages p ON l.page_id = p.page_id
         WHERE p.url LIKE '%/en/%')
SELECT page_id, link, name FROM l
WHERE NOT EXISTS (SELECT 1 FROM have WHERE have.name = l.name)
""")
def new_links_q(spark, sf_dir):
    """Links whose file name is not already present (present = linked
    from the English pages)."""
    from ...sources.links import new_links, page_links
    pages = table(spark, sf_dir, "pages")
    links = page_links(pages)
    en = pages.filter(F.col("url").contains("/en/")).select("page_id")
    have = links.join(en, "page_id", "left_semi").select("name")
    return new_links(links, have)


# ------------------------------------------------------------ S2 / P1 / P2 / S5 / F12
# Fixed values for the generated registry-style XML (element and attribute
# names of the dump format).
XML_ELEMENTS = {
    "@ДатаСост": "data_date",
    "@ВидСубМСП": "kind",
    "ИПВклМСП/@ИННФЛ": "ind_tin",
    "ОргВклМСП/@НаимОрг": "org_name",
    "ОргВклМСП/@ИННЮЛ": "org_tin",
    "СвОКВЭД/СвОКВЭДОсн/@КодОКВЭД": "activity_code_main",
    "СвОКВЭД/СвОКВЭДДоп/@КодОКВЭД": "activity_codes_extra",
}
XML_ROOT = {"ИдФайл": "file_id", "КолДок": "doc_cnt"}


def _lineitem_xml(spark, sf_dir):
    """One XML file per lineitem row, built by Spark from the table: 0, 1 or
    2 repeated extra-code elements; every 17th order's file is truncated."""
    from ...sources.xml import ensure_parallelism
    li = ensure_parallelism(table(spark, sf_dir, "lineitem"))
    s = lambda c: F.col(c).cast("string")
    member = F.concat(s("l_orderkey"), F.lit("-"), s("l_linenumber"))
    code = F.concat(F.lpad((F.col("l_partkey") % 100).cast("string"), 2, "0"), F.lit("."),
                    F.lpad((F.col("l_suppkey") % 100).cast("string"), 2, "0"))
    dop = lambda p, c: F.concat(F.lit('<СвОКВЭДДоп КодОКВЭД="' + p),
                                (F.col(c) % 10).cast("string"), F.lit('"/>'))
    extra = (F.when(F.col("l_linenumber") % 3 == 1, dop("A", "l_suppkey"))
              .when(F.col("l_linenumber") % 3 == 2,
                    F.concat(dop("A", "l_suppkey"), dop("B", "l_partkey")))
              .otherwise(F.lit("")))
    xml = F.concat(
        F.lit('<Файл ИдФайл="'), member, F.lit('" КолДок="1"><Документ ДатаСост="'),
        F.date_format("l_shipdate", "dd.MM.yyyy"), F.lit('" ВидСубМСП="'),
        (F.col("l_linenumber") % 2 + 1).cast("string"),
        F.lit('"><ОргВклМСП НаимОрг="SUPPLIER '), s("l_suppkey"),
        F.lit('" ИННЮЛ="'), s("l_partkey"), F.lit('"/><СвОКВЭД><СвОКВЭДОсн КодОКВЭД="'),
        code, F.lit('"/>'), extra, F.lit("</СвОКВЭД></Документ></Файл>"))
    # Every 17th order's files lose their closing root tag (malformed).
    cut = F.expr("substring(xml0, 1, length(xml0) - 7)")
    return (li.select(member.alias("member"), xml.alias("xml0"), "l_orderkey")
              .select("member", F.when(F.col("l_orderkey") % 17 == 0, cut)
                       .otherwise(F.col("xml0")).alias("xml")))


_XML_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS member,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS file_id,
       '1' AS doc_cnt,
       strftime(l_shipdate, '%d.%m.%Y') AS data_date,
       CAST(l_linenumber % 2 + 1 AS VARCHAR) AS kind,
       CAST(NULL AS VARCHAR) AS ind_tin,
       'SUPPLIER ' || CAST(l_suppkey AS VARCHAR) AS org_name,
       CAST(l_partkey AS VARCHAR) AS org_tin,
       lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0') || '.'
         || lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0') AS activity_code_main,
       CASE l_linenumber % 3
         WHEN 1 THEN 'A' || CAST(l_suppkey % 10 AS VARCHAR)
         WHEN 2 THEN 'A' || CAST(l_suppkey % 10 AS VARCHAR) || ',B' || CAST(l_partkey % 10 AS VARCHAR)
       END AS activity_codes_extra
FROM lineitem WHERE l_orderkey % 17 <> 0"""


@register("xml_documents", _XML_SQL)
def xml_documents_q(spark, sf_dir):
    """S2 + P1 + P2 + S5: XML files parsed by from_xml; absent attribute ->
    null, repeated -> joined with ',', leading-zero codes kept as text,
    truncated files quarantined."""
    from ...sources.xml import parse_files
    docs, _ = parse_files(_lineitem_xml(spark, sf_dir), XML_ELEMENTS, root_attrs=XML_ROOT)
    return docs


@register("xml_quarantine", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS member
FROM lineitem WHERE l_orderkey % 17 = 0
""")
def xml_quarantine_q(spark, sf_dir):
    """The members that failed to parse."""
    from ...sources.xml import parse_files
    _, bad = parse_files(_lineitem_xml(spark, sf_dir), XML_ELEMENTS, root_attrs=XML_ROOT)
    return bad.select("member")


# ------------------------------------------------------------ S3 / S4
#: Rows that one generated file or archive holds on average, at the most.
_ROWS_PER_FILE = 50_000


def _files(rows, least):
    """Files for a batch of ``rows``: ``least``, more if a task would write too many rows."""
    return max(least, -(-rows.count() // _ROWS_PER_FILE))


def _packed(rows, out, prefix="part"):
    """``rows`` written as archives: one per core at least, so packing runs in parallel."""
    from ...sources.archive import write_archives
    return write_archives(rows, out, _files(rows, rows.sparkSession.sparkContext.defaultParallelism), prefix=prefix)


def _orders_xml(spark, sf_dir, where=None):
    o = table(spark, sf_dir, "orders")
    if where is not None:
        o = o.filter(where)
    s = lambda c: F.col(c).cast("string")
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?><Файл ИдФайл="O'), s("o_orderkey"),
        F.lit('" КолДок="1"><Документ ДатаСост="'), F.date_format("o_orderdate", "dd.MM.yyyy"),
        F.lit('" ДатаДок="'), F.date_format("o_orderdate", "dd.MM.yyyy"),
        F.lit('"><СведНП ИННЮЛ="'), s("o_custkey"),
        F.lit('"/><СведДохРасх СумДоход="'), s("o_totalprice"),
        F.lit('" СумРасход="0"/></Документ></Файл>'))
    return o.select(F.concat(F.lit("O"), s("o_orderkey"), F.lit(".xml")).alias("member"),
                    xml.alias("xml"))


_ZIP_SQL = """
SELECT 'O' || CAST(o_orderkey AS VARCHAR) || '.xml' AS member,
       lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS org_tin,
       o_totalprice AS revenue, CAST(0.0 AS DOUBLE) AS expenditure,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS data_date
FROM orders"""


def _typed_with_member(docs):
    from ...sources.schemas import INPUT_DATE_FORMAT
    return docs.select(
        "member",
        F.lpad("org_tin", 10, "0").alias("org_tin"),
        F.col("revenue").try_cast("double").alias("revenue"),
        F.col("expenditure").try_cast("double").alias("expenditure"),
        iso_date(F.try_to_timestamp(F.col("data_date"), F.lit(INPUT_DATE_FORMAT)))
         .alias("data_date"))


@register("zip_scan", _ZIP_SQL)
def zip_scan_q(spark, sf_dir):
    """S3: orders rendered as XML members, packed into zip archives on the
    shared checkpoint storage, scanned back member by member and parsed."""
    from ...sources.archive import scan_archives
    out = _scratch(spark, "zip-scan")
    _packed(_orders_xml(spark, sf_dir), out).collect()
    return _typed_with_member(_parse_revexp(scan_archives(spark, out)))


def _parse_revexp(members):
    from ...sources.schemas import ELEMENTS
    from ...sources.xml import parse_files
    docs, _ = parse_files(members, ELEMENTS["revexp"], keep=("member",))
    return docs


@register("incremental_ingest", _ZIP_SQL.replace(
    "\nFROM orders", ",\n       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END AS run\nFROM orders"))
def incremental_ingest_q(spark, sf_dir):
    """The first run extracts the archives present then (orders before
    1998) and records them in the manifest; later archives arrive; the second
    run extracts only those; a third run finds nothing. All extracted rows,
    labelled by run."""
    from ...sources.archive import (list_archives, list_members, new_archives,
                                   read_members, record_ingested)
    out = _scratch(spark, "ingest")
    manifest, extracted = out + "-manifest", out + "-extracted"
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")
    for run, wave in ((1, cut), (2, ~cut), (3, None)):
        if wave is not None:
            _packed(_orders_xml(spark, sf_dir, wave), out, prefix=f"run{run}").count()
        new = new_archives(list_archives(spark, out), manifest)
        docs = _typed_with_member(_parse_revexp(read_members(list_members(new))))
        docs.withColumn("run", F.lit(run)).write.mode("append").parquet(extracted)
        record_ingested(new, manifest)
    return spark.read.parquet(extracted)


# ------------------------------------------------------------ S1 / S6
_CSV_SQL = """
SELECT c_custkey,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name || ' "q"; x' END AS name,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS acctbal,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment
FROM customer"""


@register("csv_roundtrip", _CSV_SQL)
def csv_roundtrip_q(spark, sf_dir):
    """S6 then S1: write with NA nulls, quotes and separators inside values,
    ';' as separator; read back with the same schema and null token."""
    from pyspark.sql import types as T
    from ...sources.csv import read_snapshots, write_csv
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    df = c.select(
        "c_custkey",
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat("c_name", F.lit(' "q"; x')))
         .alias("name"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("acctbal"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("segment"))
    out = _scratch(spark, "csv")
    write_csv(df, out, sep=";")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()),
                           T.StructField("name", T.StringType()),
                           T.StructField("acctbal", T.DoubleType()),
                           T.StructField("segment", T.StringType())])
    return read_snapshots(spark, out, schema, glob="*.csv", sep=";")


# ------------------------------------------------------------ S4 (streaming)
@register("streaming_ingest", _ZIP_SQL)
def streaming_ingest_q(spark, sf_dir):
    """S4 streaming form: two arrival waves of archives, each picked up by an
    available-now run of the same checkpointed stream; the output holds
    every order exactly once."""
    from ...streaming.ingest import ingest_stream
    base = _scratch(spark, "stream")
    arrivals, out = base + "-in", base + "-out"
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")
    for i, wave in enumerate([cut, ~cut]):
        _packed(_orders_xml(spark, sf_dir, wave), arrivals, prefix=f"wave{i}").collect()
        q = ingest_stream(spark, arrivals, out, _parse_revexp, name=os.path.basename(base),
                          checkpoint_location=base + "-ckpt")
        q.awaitTermination()
    return _typed_with_member(spark.read.parquet(out))


# ------------------------------------------------------------ S9
_XML_SOURCE_SQL = """
SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS doc_id,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS data_date,
       o_orderpriority AS priority,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS status
FROM orders"""


@register("xml_file_source", _XML_SOURCE_SQL)
def xml_file_source_q(spark, sf_dir):
    """Orders written as XML files (many documents under one root per
    file), read back by Spark's XML file source with an explicit schema
    (rowTag = the document element), then typed."""
    from pyspark.sql import types as T
    from ...sources.xml import read_xml_documents, write_xml_files
    o = table(spark, sf_dir, "orders")
    s = lambda c: F.col(c).cast("string")
    status = F.when(F.col("o_orderkey") % 4 == 0, F.lit("")).otherwise(
        F.concat(F.lit(' Статус="'), s("o_orderstatus"), F.lit('"')))
    doc = F.concat(F.lit('<Документ Ид="O'), s("o_orderkey"), F.lit('" ДатаСост="'),
                   F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit('"'), status,
                   F.lit('><Приоритет Код="'), s("o_orderpriority"), F.lit('"/></Документ>'))
    out = _scratch(spark, "xml-files")
    write_xml_files(o.select(doc.alias("doc")), out, _files(o, 4)).collect()
    schema = T.StructType([
        T.StructField("_Ид", T.StringType()), T.StructField("_ДатаСост", T.StringType()),
        T.StructField("_Статус", T.StringType()),
        T.StructField("Приоритет", T.StructType([T.StructField("_Код", T.StringType())]))])
    d = read_xml_documents(spark, out, "Документ", schema)
    return d.select(F.col("_Ид").alias("doc_id"),
                    iso_date(F.to_date(F.col("_ДатаСост"), "dd.MM.yyyy")).alias("data_date"),
                    F.col("Приоритет._Код").alias("priority"), F.col("_Статус").alias("status"))
