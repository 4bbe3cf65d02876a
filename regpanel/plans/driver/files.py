"""Queries over files that Spark first writes from the driver tables: statistics tables, dimensions,
appended batches, exports, inferred XML, and the extraction runs (S7-S9, S12-S14, S3 slices, C1)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _scratch, iso_date, register, table
from .geocoding import _GEOCODED, _geo_dims, _geocode_ctes
from .registry import _HULL_SQL, _registry_snapshots
from .sources import _files, _orders_xml, _packed

#: Every year that the tables hold.
_YEARS = [str(y) for y in range(1992, 2003)]
_PER_YEAR = ", ".join(f"sum(CASE WHEN year(o_orderdate) = {y} THEN o_totalprice END) AS y{y}" for y in _YEARS)


# ------------------------------------------------------------ S13
@register("statistics_scan", f"""
WITH f AS (SELECT n_nationkey AS k, n_nationkey % 4 + 3 + count(c_custkey) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey),
b AS (SELECT k, sum(n) OVER (ORDER BY CAST(k AS VARCHAR)) - n + k % 4 + 3 AS first FROM f),
v AS (SELECT c_custkey, c_nationkey, c_name, c_mktsegment, {_PER_YEAR}
      FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_name || ', "nation" ' || CAST(c_nationkey AS VARCHAR) AS region_name, c_mktsegment AS activity, {", ".join(f"round(y{y}, 2) AS y{y}" for y in _YEARS)},
       CAST(b.first + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS BIGINT) AS row_no
FROM v JOIN b ON b.k = c_nationkey
""")
def statistics_scan_q(spark, sf_dir):
    """One statistics file per nation with a row per customer and a column per year, each with a preamble of
    its own length, header and label line, quotes, separators and blanks in text; read back with its line numbers."""
    from ...sources.csv import read_statistics_table
    customers, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    orders = table(spark, sf_dir, "orders")
    sums = orders.groupBy("o_custkey").agg(*[F.round(F.sum(F.when(F.year("o_orderdate") == int(y), F.col("o_totalprice"))), 2).alias(f"y{y}") for y in _YEARS])
    name = F.concat(F.lit("  "), F.col("c_name"), F.lit(', "nation" '), F.col("c_nationkey").cast("string"), F.lit(" "))
    row = F.struct(F.col("c_custkey").alias("no"), name.alias("name"), F.concat("c_mktsegment", F.lit(" ")).alias("segment"), *[f"y{y}" for y in _YEARS])
    key = F.col("n_nationkey").alias("nation")
    preamble = nation.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_nationkey") % 4)).alias("at"), F.concat(F.lit("Statistics of "), "n_name").alias("line"))
    heads = nation.select(key, F.posexplode(F.array(F.lit("," * 3 + ",".join(_YEARS)), F.lit(",region,activity" + ",units" * len(_YEARS)))).alias("i", "line"))
    data = customers.join(sums, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_nationkey").alias("nation"), (F.col("c_custkey") + 100).alias("at"), F.to_csv(row, {"escape": '"'}).alias("line"))
    # A nation without customers has no file.
    used = customers.select(F.col("c_nationkey").alias("nation")).distinct()
    lines = preamble.unionByName(heads.select("nation", (F.col("i") + 50).cast("long").alias("at"), "line")).join(used, "nation", "left_semi").unionByName(data)
    out = _scratch(spark, "statistics")
    lines.repartition("nation").sortWithinPartitions("nation", "at").select("nation", "line").write.partitionBy("nation").text(out)
    read = read_statistics_table(spark, out, ["region_name", "activity"], _YEARS, recursiveFileLookup=True)
    return read.select("region_name", "activity", *[F.col(y).alias(f"y{y}") for y in _YEARS], F.col("_row").alias("row_no"))


# ------------------------------------------------------------ S8
@register("dimension_scan", """
SELECT row_number() OVER (ORDER BY c_custkey % 4 = 0, c_custkey) - 1 AS id, n_name AS region,
       CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS area, c_name AS city, c_acctbal AS geo_lat,
       CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS DOUBLE) END AS geo_lon
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def dimension_scan_q(spark, sf_dir):
    """A base dimension and an additional one without all columns, each in several files; united
    with a running id in the order of the files and their rows."""
    from ...sources.dims import load_cities
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    cities = rows.select(F.col("n_name").alias("region"), F.col("c_mktsegment").alias("area"), F.col("c_name").alias("city"),
                         F.col("c_acctbal").alias("geo_lat"), F.when(key % 5 != 0, F.col("c_nationkey")).alias("geo_lon"), "c_custkey")
    base, additional = _scratch(spark, "cities"), _scratch(spark, "cities-additional")
    # A sorted write: its files follow each other in the order of the keys.
    cities.where(key % 4 != 0).orderBy("c_custkey").drop("c_custkey").write.options(header="true", escape='"').csv(base)
    cities.where(key % 4 == 0).orderBy("c_custkey").select("geo_lon", "geo_lat", "city", "region").write.options(header="true", escape='"').csv(additional)
    return load_cities(spark, base, additional).select("id", "region", "area", "city", "geo_lat", "geo_lon")


# ------------------------------------------------------------ S7
@register("append_csv", """
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority || ', "p"' END AS priority,
       'status-' || o_orderstatus AS batch
FROM orders
""")
def append_csv_q(spark, sf_dir):
    """Orders appended in three batches; the first is appended twice, the second after an attempt
    that died with rows written; every order is there once."""
    from ...sources.csv import append_csv, read_appended, write_csv
    o = table(spark, sf_dir, "orders")
    rows = o.withColumn("priority", F.when(F.col("o_orderkey") % 3 != 0, F.concat("o_orderpriority", F.lit(', "p"'))))
    columns, path = ["o_orderkey", "o_custkey", "o_totalprice", "priority"], _scratch(spark, "append")
    batch = {s: rows.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")}
    append_csv(batch["F"], path, columns, batch_id="status-F")
    append_csv(batch["F"], path, columns, batch_id="status-F")
    write_csv(batch["O"].unionByName(batch["F"]).select(*columns), f"{path}/batch=status-O")
    append_csv(batch["O"], path, columns, batch_id="status-O")
    append_csv(batch["P"], path, columns, batch_id="status-P")
    schema = T.StructType([T.StructField(c, t) for c, t in zip(columns, (T.LongType(), T.LongType(), T.DoubleType(), T.StringType()))])
    return read_appended(spark, path, schema)


# ------------------------------------------------------------ S14
@register("whole_number_export", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, printf('%.0f', (l_quantity - 25) / 2) AS half,
       printf('%.0f', -l_discount) AS small, CASE WHEN l_linenumber <> 2 THEN printf('%.0f', l_extendedprice * 1152921504606846976) END AS large,
       printf('%.0f', l_extendedprice * -1099511627776) AS middle
FROM lineitem
""")
def whole_number_export_q(spark, sf_dir):
    """Halves, negative zeros, nulls and values far beyond 2^53 exported as ``%.0f`` text, read back."""
    from ...sources.csv import format_whole_numbers, read_snapshots, write_csv
    price = F.col("l_extendedprice")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), ((F.col("l_quantity") - 25) / 2).alias("half"), (-F.col("l_discount")).alias("small"),
        F.when(F.col("l_linenumber") != 2, price * 2.0 ** 60).alias("large"), (price * -2.0 ** 40).alias("middle"))
    out, texts = _scratch(spark, "whole"), ["half", "small", "large", "middle"]
    write_csv(format_whole_numbers(rows, texts), out)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in texts]])
    return read_snapshots(spark, out, schema, glob="*.csv")


# ------------------------------------------------------------ S9, inferred
_INFERRED = ("_Дата date, _ИНН string, _Ид bigint, _Код string, _Льгота boolean, _Пометка string, _Сумма decimal(38,2), _Сутки double, "
             "Доп array<struct<_Код:string,_Номер:bigint>>, СведНП struct<_Ставка:decimal(38,1),_Статус:string>")


@register("xml_inferred", f"""
SELECT o_orderkey AS id, lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS tin,
       lpad(CAST(o_custkey % 90 + 1 AS VARCHAR), 2, '0') || '.' || CAST(o_orderkey % 10 AS VARCHAR) || '0' AS code,
       CAST(printf('%.2f', o_totalprice) AS DOUBLE) AS total, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day, o_orderkey % 2 = 0 AS relief,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 4 / 4 END AS part, o_orderstatus AS status,
       CAST(o_orderkey % 100 AS DOUBLE) / 10 AS rate, CASE WHEN o_orderkey % 7 = 0 THEN '1-' || o_orderpriority ELSE CAST(o_orderkey AS VARCHAR) END AS note,
       CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '01' ELSE '01,' || o_orderpriority END AS extra_codes,
       CAST(CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN o_custkey ELSE o_custkey + 1 END AS BIGINT) AS extra_sum, '{_INFERRED}' AS types
FROM orders
""")
def xml_inferred_q(spark, sf_dir):
    """Orders as XML, their schema inferred and corrected (codes with zeros stay text, amounts of two
    decimals become decimals), written as Parquet, read back and selected by nested attributes."""
    from ...sources.xml import infer_xml_schema, read_xml_documents, write_xml_files
    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    s = lambda c: c.cast("string")
    attr = lambda name, value: F.concat(F.lit(f' {name}="'), value, F.lit('"'))
    extra = lambda code, number: F.concat(F.lit("<Доп"), attr("Код", code), attr("Номер", s(number)), F.lit("/>"))
    part = F.when(key % 5 == 0, F.lit("")).otherwise(attr("Сутки", F.element_at(F.array(*map(F.lit, ("0", "0.25", "0.5", "0.75"))), (key % 4 + 1).cast("int"))))
    doc = F.concat(
        F.lit("<Документ"), attr("Ид", s(key)), attr("ИНН", F.lpad(s(cust), 12, "0")),
        attr("Код", F.concat(F.lpad(s(cust % 90 + 1), 2, "0"), F.lit("."), s(key % 10), F.lit("0"))), attr("Сумма", F.format_string("%.2f", "o_totalprice")),
        attr("Дата", iso_date("o_orderdate")), attr("Льгота", F.when(key % 2 == 0, "true").otherwise("false")), part,
        attr("Пометка", F.when(key % 7 == 0, F.concat(F.lit("1-"), "o_orderpriority")).otherwise(s(key))), F.lit("><СведНП"), attr("Статус", F.col("o_orderstatus")),
        attr("Ставка", F.format_string("%.1f", (key % 100).cast("double") / 10)), F.lit("/>"),
        F.when(key % 3 >= 1, extra(F.lit("01"), cust)).otherwise(F.lit("")), F.when(key % 3 == 2, extra(F.col("o_orderpriority"), F.lit(1))).otherwise(F.lit("")),
        F.lit("</Документ>"))
    out, kept = _scratch(spark, "xml-inferred"), _scratch(spark, "xml-parquet")
    write_xml_files(o.select(doc.alias("doc")), out, _files(o, 4)).collect()
    schema = infer_xml_schema(spark, out, "Документ")
    read_xml_documents(spark, out, "Документ", schema).write.parquet(kept)
    d = spark.read.parquet(kept)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema.fields)
    return d.select(F.col("_Ид").alias("id"), F.col("_ИНН").alias("tin"), F.col("_Код").alias("code"), F.col("_Сумма").cast("double").alias("total"),
                    iso_date("_Дата").alias("day"), F.col("_Льгота").alias("relief"), F.col("_Сутки").alias("part"), F.col("СведНП._Статус").alias("status"),
                    F.col("СведНП._Ставка").cast("double").alias("rate"), F.col("_Пометка").alias("note"),
                    F.coalesce(F.array_join("Доп._Код", ","), F.lit("")).alias("extra_codes"),
                    F.coalesce(F.aggregate("Доп._Номер", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).cast("long").alias("extra_sum"), F.lit(types).alias("types"))


# ------------------------------------------------------------ C1
@register("extract_pipeline", """
SELECT 'O' || CAST(o_orderkey AS VARCHAR) || '.xml' AS member, CASE WHEN o_orderkey % 17 = 0 THEN 'quarantine' ELSE 'ok' END AS status,
       CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS org_tin, CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS revenue,
       CASE WHEN o_orderkey % 17 <> 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS data_date
FROM orders
""")
def extract_pipeline_q(spark, sf_dir):
    """A run over half-loaded archives puts all members into quarantine and dies before its manifest; the
    archives arrive whole, the replayed run replaces what it left, a third run finds nothing new."""
    from ..extract import extract
    from ..pipeline import run_extract, write_extract
    base = _scratch(spark, "extract")
    source, target = f"{base}/download/revexp", f"{base}/extract/revexp"
    rows = _orders_xml(spark, sf_dir)
    cut = F.expr("substring(xml, 1, length(xml) - 7)")
    _packed(rows.select("member", cut.alias("xml")), source).count()
    write_extract(extract(spark, source, "revexp"), target, "extract_revexp", {})
    broken = F.regexp_extract("member", r"\d+", 0).cast("long") % 17 == 0
    _packed(rows.select("member", F.when(broken, cut).otherwise(F.col("xml")).alias("xml")), source).count()
    run_extract(spark, base, None)
    run_extract(spark, base, None)
    return spark.read.parquet(target).select("member", F.col("_status").alias("status"), "org_tin", "revenue", iso_date("data_date").alias("data_date"))


# ------------------------------------------------------------ S12, S3 slices
def _snapshot_files(spark, sf_dir):
    """Registry snapshots of orders, one archive per year, a member for each run of 64 order keys."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    s = lambda c: F.col(c).cast("string")
    person = F.col("o_orderkey") % 3 == 0
    doc = F.concat(F.lit('<Документ ДатаСост="'), F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit('" ВидСубМСП="1">'),
                   F.when(person, F.concat(F.lit('<ИПВклМСП ИННФЛ="'), s("o_custkey"), F.lit('"/>'))).otherwise(F.concat(F.lit('<ОргВклМСП НаимОрг="'), "c_name", F.lit('" ИННЮЛ="'), s("o_custkey"), F.lit('"/>'))),
                   F.lit('<СведМН КодРегион="7"><Регион Тип="обл" Наим="'), s("c_nationkey"), F.lit('"/></СведМН><СвОКВЭД><СвОКВЭДОсн КодОКВЭД="01.'),
                   F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"), F.lit('"/></СвОКВЭД></Документ>'))
    run = F.floor(F.col("o_orderkey") / 64)
    # At most 64 documents a member.
    files = o.groupBy(F.year("o_orderdate").alias("year"), run.alias("run")).agg(F.array_join(F.sort_array(F.collect_list(doc)), "").alias("docs"))
    return files.select(F.format_string("data-1012%d-structure.zip", "year").alias("name"), F.format_string("m%012d.xml", "run").alias("member"),
                        F.concat(F.lit('<?xml version="1.0" encoding="utf-8"?><Файл ИдФайл="F">'), "docs", F.lit("</Файл>")).alias("xml"))


_SNAPSHOT_DOCS = """
docs AS (SELECT year(o_orderdate) AS year, o_orderkey // 64 AS run, strftime(CAST(o_orderdate AS DATE), '%d.%m.%Y') AS data_date,
                CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END AS ind_tin, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS org_tin,
                CAST(c_nationkey AS VARCHAR) AS region_name, '01.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS activity_code_main
         FROM orders JOIN customer ON o_custkey = c_custkey)"""

#: The yearly snapshots that are picked: all but one year.
_PICKED = [f"data-1012{y}-structure.zip" for y in range(1992, 2010) if y != 1995]


@register("validation_extract", f"""
WITH {_SNAPSHOT_DOCS}
SELECT 'data-1012' || CAST(year AS VARCHAR) || '-structure.zip' AS archive, printf('m%012d.xml', run) AS member,
       data_date, ind_tin, org_tin, region_name, activity_code_main FROM docs WHERE year <> 1995
""")
def validation_extract_q(spark, sf_dir):
    """Five attributes of the yearly snapshots on a hand-picked list of archives."""
    from ...sources.archive import write_named_archives
    from ...sources.schemas import VALIDATION_ELEMENTS
    from ..extract import extract
    out = _scratch(spark, "validation-extract")
    write_named_archives(_snapshot_files(spark, sf_dir), out).count()
    docs = extract(spark, out, "smb", elements=VALIDATION_ELEMENTS, archive_names=_PICKED).documents
    return docs.select(F.substring_index("archive", "/", -1).alias("archive"), "member", *VALIDATION_ELEMENTS.values())


@register("member_slices", f"""
WITH {_SNAPSHOT_DOCS},
m AS (SELECT year, run, count(*) AS n_docs, row_number() OVER (PARTITION BY year ORDER BY run) - 1 AS place, count(*) OVER (PARTITION BY year) AS total
      FROM docs GROUP BY year, run)
SELECT slice, 'data-1012' || CAST(year AS VARCHAR) || '-structure.zip' AS archive, printf('m%012d.xml', run) AS member, n_docs FROM (
  SELECT '[1::3]' AS slice, * FROM m WHERE place >= 1 AND (place - 1) % 3 = 0
  UNION ALL SELECT '[-20:-2:4]', * FROM m WHERE place >= greatest(0, total - 20) AND place < total - 2 AND (place - greatest(0, total - 20)) % 4 = 0
  UNION ALL SELECT '[::-5]', * FROM m WHERE (total - 1 - place) % 5 = 0
  UNION ALL SELECT '[:10]', * FROM m WHERE place < 10)
""")
def member_slices_q(spark, sf_dir):
    """S3: slices of the members of every archive, by their order in it, with bounds from either end."""
    from ...sources.archive import list_archives, list_members, read_members, write_named_archives
    out = _scratch(spark, "member-slices")
    write_named_archives(_snapshot_files(spark, sf_dir), out).count()
    rows = None
    for start, stop, step in ((1, None, 3), (-20, -2, 4), (None, None, -5), (None, 10, None)):
        name = "[" + ":".join("" if x is None else str(x) for x in ((start, stop) if step is None else (start, stop, step))) + "]"
        part = list_members(list_archives(spark, out), start=start, stop=stop, step=step).withColumn("slice", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    from ...session import cut_lineage
    rows = cut_lineage(rows)
    docs = read_members(rows.select("archive", "member").distinct()).select("archive", "member", (F.size(F.split("xml", "<Документ ")) - 1).cast("long").alias("n_docs"))
    return rows.join(docs, ["archive", "member"]).select("slice", F.substring_index("archive", "/", -1).alias("archive"), "member", "n_docs")


# ------------------------------------------------------------ C9
def _document(values):
    """A document element with the values of paths (``A/B/@c`` -> column); a null makes no attribute."""
    tree = {}
    for path, value in values.items():
        node = tree
        for step in path.split("/"):
            node = node.setdefault(step, value if step.startswith("@") else {})

    def element(tag, node):
        parts = [F.lit("<" + tag)]
        for name, value in node.items():
            if name.startswith("@"):
                text = F.replace(F.replace(F.replace(value.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
                parts.append(F.coalesce(F.concat(F.lit(f' {name[1:]}="'), text, F.lit('"')), F.lit("")))
        inner = [element(name, child) for name, child in node.items() if not name.startswith("@")]
        return F.concat(*parts, F.lit(">"), *inner, F.lit(f"</{tag}>"))

    return element("Документ", tree)


#: Order keys whose documents share an archive: an archive is one file with one writer, so a year has several.
_KEYS_PER_ARCHIVE = 1 << 19


def _archive(date, key):
    """The archive of a document: those of a year follow each other in the order of the keys."""
    return F.format_string("data-%d-%012d.zip", F.year(date), F.floor(F.col(key) / _KEYS_PER_ARCHIVE))


def _dump(rows, name, member, doc):
    """Rows as archive members, the documents of a member in one file."""
    files = rows.groupBy(name.alias("name"), member.alias("member")).agg(F.array_join(F.sort_array(F.collect_list(doc)), "").alias("docs"))
    return files.select("name", "member", F.concat(F.lit('<?xml version="1.0" encoding="utf-8"?><Файл ИдФайл="F" КолДок="1">'), "docs", F.lit("</Файл>")).alias("xml"))


_ANY_REGION = _HULL_SQL.replace("NOT (region_name ILIKE '%NATION_1%' OR region_name ILIKE '%ATION_2%')", "region_name IS NOT NULL")
_FACTS = """
facts AS (SELECT * FROM (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS tin, CAST(year(o_orderdate) AS BIGINT) AS year, o_totalprice AS revenue, CAST(o_orderkey % 500 AS BIGINT) AS employees_count,
         row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY CAST(o_orderdate AS DATE) DESC, o_totalprice DESC) AS by_price,
         row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey % 500 DESC) AS by_size
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_custkey % 13 <> 0 AND c_mktsegment IN ('BUILDING', 'AUTOMOBILE')))"""


@register("full_pipeline", f"""
{_geocode_ctes(_ANY_REGION)},
geocoded AS ({_GEOCODED}),
{_FACTS},
panel AS (SELECT *, unnest(generate_series(CAST(left(start_date, 4) AS BIGINT), CAST(left(end_date, 4) AS BIGINT))) AS year FROM geocoded)
SELECT p.tin, p.reg_number, p.org_name, p.region, p.region_iso_code, p.area, p.settlement, p.oktmo, p.lat, p.start_date, p.end_date, p.year, r.revenue, e.employees_count,
       (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS n_extracted, (SELECT count(*) FROM hull WHERE rn = 1) AS n_intervals,
       (SELECT count(*) FROM facts WHERE by_price = 1) AS n_facts, (SELECT count(*) FROM geocoded) AS n_geocoded, (SELECT count(*) FROM panel) AS n_panel
FROM panel p LEFT JOIN facts r ON r.tin = p.tin AND r.year = p.year AND r.by_price = 1
             LEFT JOIN facts e ON e.tin = p.tin AND e.year = p.year AND e.by_size = 1
""")
def full_pipeline_q(spark, sf_dir):
    """Zipped XML of all three datasets -> extraction -> intervals and facts -> geocoding -> panel, in one run
    whose stages report their row counts (A9)."""
    from ...sources.archive import write_named_archives
    from ...sources.schemas import ELEMENTS
    from ..pipeline import Dimensions, report, run_all
    base = _scratch(spark, "pipeline")
    snaps = _registry_snapshots(spark, sf_dir)
    keyed = F.coalesce("ind_tin", "org_tin").cast("long")
    snaps = snaps.withColumns({"settlement_name": F.when(keyed % 3 == 0, F.concat(F.lit("s"), (keyed % 40).cast("string"))),
                               "settlement_type": F.when(keyed % 3 == 0, F.lit("д")), "reestr_date": F.lit(None).cast("date")})
    as_text = {"data_date": F.date_format("data_date", "dd.MM.yyyy")}
    smb = _document({path: as_text.get(c, F.col(c)) for path, c in ELEMENTS["smb"].items()})
    # A snapshot a member, so that the order of a day's snapshots is that of their members.
    write_named_archives(_dump(snaps, _archive("data_date", "_snap"), F.format_string("m%012d.xml", "_snap"), smb), f"{base}/download/smb").count()
    o = table(spark, sf_dir, "orders")
    period, run = F.format_string("31.12.%d", F.year("o_orderdate")), F.format_string("m%012d.xml", F.floor(F.col("o_orderkey") / 64))
    archive = _archive("o_orderdate", "o_orderkey")
    common = {"СведНП/@ИННЮЛ": F.col("o_custkey"), "@ДатаСост": period, "@ДатаДок": F.date_format("o_orderdate", "dd.MM.yyyy")}
    for ds, own in (("revexp", {"СведДохРасх/@СумДоход": F.col("o_totalprice"), "СведДохРасх/@СумРасход": F.lit(0)}), ("empl", {"СведССЧР/@КолРаб": F.col("o_orderkey") % 500})):
        write_named_archives(_dump(o, archive, run, _document(common | own)), f"{base}/download/{ds}").count()
    regions, cities, settlements, abbr = _geo_dims(spark, sf_dir)
    metrics = {}
    panel = run_all(spark, base, Dimensions(cities, settlements, regions, abbr), metrics=metrics)
    n = report(metrics)
    return panel.select("tin", "reg_number", "org_name", "region", "region_iso_code", "area", "settlement", "oktmo", "lat", iso_date("start_date").alias("start_date"),
                        iso_date("end_date").alias("end_date"), F.col("year").cast("long").alias("year"), "revenue", F.col("employees_count").cast("long").alias("employees_count"),
                        *[F.lit(n[k]).cast("long").alias(c) for k, c in (("extract_smb", "n_extracted"), ("aggregate_smb", "n_intervals"), ("aggregate_revexp", "n_facts"),
                                                                         ("geocode", "n_geocoded"), ("panel", "n_panel"))])
