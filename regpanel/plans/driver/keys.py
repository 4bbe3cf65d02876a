"""Key, filter and text-rendering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import EXCLUDED_NATIONS, _customers_with_nation, register, table


# ------------------------------------------------------------ P4
@register("exclude_patterns", """
SELECT c_custkey, region_name FROM (
  SELECT c.c_custkey,
         CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE n.n_name END AS region_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
WHERE NOT (region_name ILIKE '%nation_1%' OR region_name ILIKE '%ATION_2%')
""")
def exclude_patterns_q(spark, sf_dir):
    """Drop rows whose region name contains any excluded pattern
    (case-insensitive); a null region name drops the row too."""
    from ...operators.keys import exclude_substrings
    df = _customers_with_nation(spark, sf_dir).select(
        "c_custkey", F.when(F.col("c_custkey") % 11 == 0, F.lit(None))
                      .otherwise(F.col("n_name")).alias("region_name"))
    return exclude_substrings(df, "region_name", EXCLUDED_NATIONS)


# ------------------------------------------------------------ P5-P7
@register("normalize_keys", """
SELECT c_custkey,
       coalesce(lpad(ind_tin, 12, '0'), lpad(org_tin, 10, '0')) AS tin,
       coalesce(ind_number, org_number) AS reg_number,
       upper(c_name) AS name
FROM (SELECT c_custkey, c_name,
             CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS ind_tin,
             CAST(c_custkey * 100000007 AS VARCHAR) AS org_tin,
             CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'IP' || CAST(c_custkey AS VARCHAR) END AS ind_number,
             'OGRN' || CAST(c_nationkey AS VARCHAR) AS org_number
      FROM customer)
""")
def normalize_keys_q(spark, sf_dir):
    """P5 + P6 + P7: person ids padded to 12, organisation ids to 10 (longer
    ones cut), person id preferred; names upper-cased."""
    from ...operators.keys import entity_key, upper_columns
    c = table(spark, sf_dir, "customer")
    df = c.select(
        "c_custkey", F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(None))
         .otherwise(F.col("c_custkey").cast("string")).alias("ind_tin"),
        (F.col("c_custkey") * 100000007).cast("string").alias("org_tin"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("IP"), F.col("c_custkey").cast("string"))).alias("ind_number"),
        F.concat(F.lit("OGRN"), F.col("c_nationkey").cast("string")).alias("org_number"))
    df = upper_columns(df, ["name"])
    df = entity_key(df, "ind_tin", "org_tin", person_reg="ind_number", org_reg="org_number")
    return df.select("c_custkey", "tin", "reg_number", "name")


# ------------------------------------------------------------ P3
REQUESTED_CODES = ["E", "Brand#1", "Brand#27", "Brand#3.05"]

_CLASSIFIER_SQL = """
cls AS (SELECT DISTINCT upper(substr(p_type, 1, 1)) AS grp,
               p_brand || '.' || lpad(CAST(p_size % 10 AS VARCHAR), 2, '0') AS code
        FROM part),
req AS (SELECT * FROM (VALUES ('E'), ('Brand#1'), ('Brand#27'), ('Brand#3.05')) t(c)),
hit AS (SELECT DISTINCT code FROM cls, req
        WHERE (length(c) = 1 AND c BETWEEN 'A' AND 'Z' AND grp = c)
           OR (NOT (length(c) = 1 AND c BETWEEN 'A' AND 'Z') AND starts_with(code, c))),
miss AS (SELECT c AS code FROM req WHERE NOT EXISTS (
           SELECT 1 FROM cls
           WHERE (length(c) = 1 AND c BETWEEN 'A' AND 'Z' AND grp = c)
              OR (NOT (length(c) = 1 AND c BETWEEN 'A' AND 'Z') AND starts_with(code, c)))),
codes AS (SELECT code FROM hit UNION SELECT code FROM miss)"""


def _classifier(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(
        F.upper(F.substring("p_type", 1, 1)).alias("group"),
        F.concat(F.col("p_brand"), F.lit("."),
                 F.lpad((F.col("p_size") % 10).cast("string"), 2, "0")).alias("code")
    ).distinct()


@register("code_filter", f"""
WITH {_CLASSIFIER_SQL}
SELECT l_orderkey, l_linenumber, code FROM (
  SELECT l_orderkey, l_linenumber,
         'Brand#' || CAST(l_partkey % 30 AS VARCHAR) || '.'
           || lpad(CAST(l_suppkey % 12 AS VARCHAR), 2, '0') AS code
  FROM lineitem)
WHERE code IN (SELECT code FROM codes)
""")
def code_filter_q(spark, sf_dir):
    """Activity-code filter -- group letters and prefixes expanded through
    the classifier, unknown requests kept as is, exact membership."""
    from ...operators.keys import filter_by_codes
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("Brand#"), (F.col("l_partkey") % 30).cast("string"), F.lit("."),
                 F.lpad((F.col("l_suppkey") % 12).cast("string"), 2, "0")).alias("code"))
    return filter_by_codes(li, "code", _classifier(spark, sf_dir), REQUESTED_CODES)


# ------------------------------------------------------------ P13
FEDERAL_REGIONS = ["NATION_1", "NATION_2"]


@register("fill_federal", """
SELECT c.c_custkey, n.n_name AS region,
       CASE WHEN n.n_name IN ('NATION_1', 'NATION_2') AND c.c_custkey % 4 = 0 THEN n.n_name
            WHEN c.c_custkey % 4 = 0 THEN NULL ELSE c.c_name END AS settlement
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def fill_federal_q(spark, sf_dir):
    """A federal-city region with no settlement is its own settlement."""
    from ...operators.keys import fill_when_null_and_in
    df = _customers_with_nation(spark, sf_dir).select(
        "c_custkey", F.col("n_name").alias("region"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(None)).otherwise(F.col("c_name"))
         .alias("settlement"))
    return fill_when_null_and_in(df, "settlement", "region", FEDERAL_REGIONS)


# ------------------------------------------------------------ P10 / P11 / P12 / P20
# Types written before the name; everything else goes after.
PREPEND_TYPES = ["Город", "Республика", "Поселок"]

_ADDRESS_SQL = """
a AS (
  SELECT c.c_custkey, n.n_name AS region,
         CASE c.c_custkey % 3 WHEN 0 THEN 'Республика' WHEN 1 THEN 'обл' ELSE NULL END AS region_type,
         c.c_mktsegment AS city,
         CASE c.c_custkey % 4 WHEN 0 THEN 'Город' WHEN 1 THEN 'посёлок' WHEN 2 THEN 'Поселок'
              ELSE 'г' END AS city_type,
         CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE 'ёлкино ' || CAST(c.c_custkey AS VARCHAR) END AS settlement
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def _compose_sql(name, typ):
    return (f"CASE WHEN {name} IS NULL OR {typ} IS NULL THEN NULL "
            f"WHEN {typ} IN ('Город', 'Республика', 'Поселок') THEN {typ} || ' ' || {name} "
            f"ELSE {name} || ' ' || {typ} END")


@register("address_render", f"""
WITH {_ADDRESS_SQL}
SELECT c_custkey,
       translate(upper({_compose_sql('region', 'region_type')}), 'Ё', 'Е') AS region_full,
       translate(upper({_compose_sql('city', 'city_type')}), 'Ё', 'Е') AS city_full,
       translate(upper(settlement), 'Ё', 'Е') AS settlement,
       concat_ws(' / ', coalesce(region, ''), coalesce(region_type, ''), coalesce(city, ''),
                 coalesce(city_type, ''), coalesce(settlement, '')) AS raw_address
FROM a
""")
def address_render_q(spark, sf_dir):
    """P10 + P12 + P20: name+type composition (some types first), canonical
    upper text with Ё folded, and the raw ' / ' rendering."""
    from ...functions.text import canonical_text, join_name_and_type, raw_address
    cn = _customers_with_nation(spark, sf_dir)
    k = F.col("c_custkey")
    a = cn.select(
        "c_custkey", F.col("n_name").alias("region"),
        F.when(k % 3 == 0, "Республика").when(k % 3 == 1, "обл").alias("region_type"),
        F.col("c_mktsegment").alias("city"),
        F.when(k % 4 == 0, "Город").when(k % 4 == 1, "посёлок").when(k % 4 == 2, "Поселок")
         .otherwise("г").alias("city_type"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("ёлкино "), k.cast("string")))
         .alias("settlement"))
    return a.select(
        "c_custkey",
        canonical_text(join_name_and_type("region", "region_type", PREPEND_TYPES)).alias("region_full"),
        canonical_text(join_name_and_type("city", "city_type", PREPEND_TYPES)).alias("city_full"),
        canonical_text("settlement").alias("settlement"),
        raw_address(["region", "region_type", "city", "city_type", "settlement"]).alias("raw_address"))
