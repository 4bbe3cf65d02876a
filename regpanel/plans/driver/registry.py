"""Registry, facts and panel queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..panel import panelize
from .common import (EXCLUDED_NATIONS, _KIND_SQL, _customers_with_nation, _registry_kinds,
                     iso_date, register, table)


# ------------------------------------------------------------ J1 / P9 / C3
@register("legal_entity_semi", f"""
SELECT o_orderkey, o_custkey FROM orders
WHERE lpad(CAST(o_custkey AS VARCHAR), 10, '0') IN (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer WHERE {_KIND_SQL} = 1)
""")
def legal_entity_semi_q(spark, sf_dir):
    """J1 + P9: facts kept only for registry entities of kind 1."""
    from ...plans.registry import legal_entities
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("tin"))
    return (o.join(legal_entities(_registry_kinds(spark, sf_dir)), "tin", "left_semi")
             .select("o_orderkey", "o_custkey"))


@register("aggregate_facts", f"""
SELECT tin, CAST(year(data_date) AS BIGINT) AS year, revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY tin, data_date
                               ORDER BY doc_date DESC NULLS LAST, o_orderkey DESC) AS rn
  FROM (SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS tin, o_orderkey,
               make_date(year(o_orderdate), 12, 31) AS data_date,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS doc_date,
               o_totalprice AS revenue
        FROM orders)
  WHERE tin IN (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer
                WHERE {_KIND_SQL} = 1))
WHERE rn = 1
""")
def aggregate_facts_q(spark, sf_dir):
    """Yearly filings -> fixed-width key -> legal entities only (semi
    join before the dedupe) -> latest revision per (tin, period) -> year."""
    from ...plans.registry import aggregate_facts
    o = table(spark, sf_dir, "orders")
    facts = o.select(
        F.col("o_custkey").cast("string").alias("org_tin"), "o_orderkey",
        F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)).alias("data_date"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None))
         .otherwise(F.to_date("o_orderdate")).alias("doc_date"),
        F.col("o_totalprice").alias("revenue"))
    out = aggregate_facts(facts, ["revenue"], _registry_kinds(spark, sf_dir),
                          tiebreak=["o_orderkey"])
    return out.select("tin", F.col("year").cast("long").alias("year"), "revenue")


# ------------------------------------------------------------ L1 / L2
@register("top_demo", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def top_demo_q(spark, sf_dir):
    """L1 + L2: ordered head with a full tie-break (planned as TakeOrdered)."""
    o = table(spark, sf_dir, "orders")
    return (o.select("o_orderkey", "o_custkey", "o_totalprice")
             .orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10))


# ------------------------------------------------------------ C2
_SNAPSHOT_SQL = """
base AS (
  SELECT o.o_orderkey AS snap, CAST(o.o_orderdate AS DATE) AS data_date,
         CASE WHEN c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 1 ELSE 2 END AS kind,
         CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS category,
         c.c_custkey, c.c_name, n.n_name, n.n_nationkey, o.o_orderpriority
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey),
snaps AS (
  SELECT snap, data_date, kind, category,
         CASE WHEN kind = 2 THEN CAST(c_custkey AS VARCHAR) END AS ind_tin,
         CASE WHEN kind = 2 AND snap % 3 <> 0 THEN 'IP' || CAST(c_custkey AS VARCHAR) END AS ind_number,
         CASE WHEN kind = 2 THEN lower(c_name) END AS first_name,
         CASE WHEN kind = 2 THEN 'Last' END AS last_name,
         CAST(NULL AS VARCHAR) AS patronymic,
         CASE WHEN kind = 1 THEN c_name END AS org_name,
         CASE WHEN kind = 1 THEN lower(substr(c_name, 1, 8)) END AS org_short_name,
         CASE WHEN kind = 1 THEN CAST(c_custkey AS VARCHAR) END AS org_tin,
         CASE WHEN kind = 1 AND snap % 4 <> 0 THEN 'OGRN' || CAST(c_custkey AS VARCHAR) END AS org_number,
         n_nationkey AS region_code,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE n_name END AS region_name,
         'обл' AS region_type,
         o_orderpriority AS district_name, 'р-н' AS district_type,
         CASE WHEN snap % 2 = 0 THEN 'city a' ELSE 'city b' END AS city_name,
         CASE WHEN snap % 5 = 0 THEN 'г' ELSE 'пгт' END AS city_type,
         CAST(NULL AS VARCHAR) AS settlement_name, CAST(NULL AS VARCHAR) AS settlement_type,
         'A.' || lpad(CAST(c_custkey % 3 AS VARCHAR), 2, '0') AS activity_code_main
  FROM base)"""


def _registry_snapshots(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cn = _customers_with_nation(spark, sf_dir)
    b = o.join(cn, o["o_custkey"] == cn["c_custkey"])
    snap, ck = F.col("o_orderkey"), F.col("c_custkey")
    kind = F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), 1).otherwise(2)
    person, org = kind == 2, kind == 1
    return b.select(
        snap.alias("_snap"), F.to_date("o_orderdate").alias("data_date"),
        kind.alias("kind"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
         .otherwise(3).alias("category"),
        F.when(person, ck.cast("string")).alias("ind_tin"),
        F.when(person & (snap % 3 != 0), F.concat(F.lit("IP"), ck.cast("string")))
         .alias("ind_number"),
        F.when(person, F.lower("c_name")).alias("first_name"),
        F.when(person, F.lit("Last")).alias("last_name"),
        F.lit(None).cast("string").alias("patronymic"),
        F.when(org, F.col("c_name")).alias("org_name"),
        F.when(org, F.lower(F.substring("c_name", 1, 8))).alias("org_short_name"),
        F.when(org, ck.cast("string")).alias("org_tin"),
        F.when(org & (snap % 4 != 0), F.concat(F.lit("OGRN"), ck.cast("string")))
         .alias("org_number"),
        F.col("n_nationkey").alias("region_code"),
        F.when(ck % 13 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("region_name"),
        F.lit("обл").alias("region_type"),
        F.col("o_orderpriority").alias("district_name"), F.lit("р-н").alias("district_type"),
        F.when(snap % 2 == 0, "city a").otherwise("city b").alias("city_name"),
        F.when(snap % 5 == 0, "г").otherwise("пгт").alias("city_type"),
        F.lit(None).cast("string").alias("settlement_name"),
        F.lit(None).cast("string").alias("settlement_type"),
        F.concat(F.lit("A."), F.lpad((ck % 3).cast("string"), 2, "0"))
         .alias("activity_code_main"))


_STATE = ("kind, category, tin, reg_number, first_name, last_name, patronymic, org_name, "
          "org_short_name, region_name, district_name, city_name, settlement_name, "
          "activity_code_main")


_HULL_SQL = f"""
norm AS (
  SELECT snap, data_date, kind, category,
         coalesce(lpad(ind_tin, 12, '0'), lpad(org_tin, 10, '0')) AS tin,
         coalesce(ind_number, org_number) AS reg_number,
         upper(first_name) AS first_name, upper(last_name) AS last_name,
         upper(patronymic) AS patronymic, upper(org_name) AS org_name,
         upper(org_short_name) AS org_short_name, region_code,
         upper(region_name) AS region_name, upper(region_type) AS region_type,
         upper(district_name) AS district_name, upper(district_type) AS district_type,
         upper(city_name) AS city_name, upper(city_type) AS city_type,
         upper(settlement_name) AS settlement_name, upper(settlement_type) AS settlement_type,
         activity_code_main
  FROM snaps
  WHERE NOT (region_name ILIKE '%NATION_1%' OR region_name ILIKE '%ATION_2%')),
filled AS (
  SELECT * REPLACE (first_value(reg_number IGNORE NULLS) OVER (
      PARTITION BY tin ORDER BY data_date, snap
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reg_number)
  FROM norm),
hull AS (
  SELECT *, row_number() OVER (PARTITION BY {_STATE} ORDER BY data_date, snap) AS rn,
         min(data_date) OVER (PARTITION BY {_STATE}) AS start_date,
         max(data_date) OVER (PARTITION BY {_STATE}) AS end_date
  FROM filled)"""


@register("registry_hull", f"""
WITH {_SNAPSHOT_SQL},
{_HULL_SQL}
SELECT CAST(kind AS BIGINT) AS kind, CAST(category AS BIGINT) AS category, tin, reg_number,
       first_name, last_name, patronymic, org_name, org_short_name,
       CAST(region_code AS BIGINT) AS region_code, region_name, region_type,
       district_name, district_type, city_name, city_type, settlement_name, settlement_type,
       activity_code_main, strftime(start_date, '%Y-%m-%d') AS start_date,
       strftime(end_date, '%Y-%m-%d') AS end_date
FROM hull WHERE rn = 1
""")
def registry_hull_q(spark, sf_dir):
    """Registry snapshots -> validity intervals."""
    from ..registry import aggregate_registry
    h = aggregate_registry(_registry_snapshots(spark, sf_dir),
                           excluded_regions=EXCLUDED_NATIONS)
    return h.withColumns({
        "kind": F.col("kind").cast("long"), "category": F.col("category").cast("long"),
        "region_code": F.col("region_code").cast("long"),
        "start_date": iso_date("start_date"), "end_date": iso_date("end_date")})


# ------------------------------------------------------------ C6 (C2 + C3 + C4)
_EMPL_SQL = """
emp AS (
  SELECT tin, year(data_date) AS year, employees_count FROM (
    SELECT *, row_number() OVER (PARTITION BY tin, data_date
                                 ORDER BY doc_date DESC NULLS LAST, l_orderkey DESC,
                                          l_linenumber DESC, employees_count DESC) AS rn2
    FROM (SELECT lpad(CAST(o.o_custkey AS VARCHAR), 10, '0') AS tin,
                 make_date(year(l.l_shipdate), 12, 31) AS data_date,
                 CAST(l.l_shipdate AS DATE) AS doc_date, l.l_orderkey, l.l_linenumber,
                 CAST(l.l_quantity AS INTEGER) AS employees_count
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
    WHERE tin IN (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer
                  WHERE """ + _KIND_SQL + """ = 1))
  WHERE rn2 = 1)"""

_REV_SQL = """
rev AS (
  SELECT tin, year(data_date) AS year, revenue FROM (
    SELECT *, row_number() OVER (PARTITION BY tin, data_date
                                 ORDER BY doc_date DESC NULLS LAST, o_orderkey DESC) AS rn3
    FROM (SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS tin, o_orderkey,
                 make_date(year(o_orderdate), 12, 31) AS data_date,
                 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS doc_date,
                 o_totalprice AS revenue
          FROM orders)
    WHERE tin IN (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer
                  WHERE """ + _KIND_SQL + """ = 1))
  WHERE rn3 = 1)"""


@register("panel_registry_facts", f"""
WITH {_SNAPSHOT_SQL},
{_HULL_SQL},
iv AS (SELECT * FROM hull WHERE rn = 1),
panel AS (SELECT tin, reg_number, district_name, start_date, end_date,
                 unnest(generate_series(year(start_date), year(end_date))) AS year
          FROM iv),
{_REV_SQL},
{_EMPL_SQL}
SELECT p.tin, p.reg_number, p.district_name, strftime(p.start_date, '%Y-%m-%d') AS start_date,
       CAST(p.year AS BIGINT) AS year, r.revenue, CAST(e.employees_count AS BIGINT) AS employees_count
FROM panel p LEFT JOIN rev r ON p.tin = r.tin AND p.year = r.year
             LEFT JOIN emp e ON p.tin = e.tin AND p.year = e.year
""")
def panel_registry_facts_q(spark, sf_dir):
    """C6 over C2 + C3 + C4: registry intervals expanded to years with the
    latest revenue filing and the latest employee filing of each year."""
    from ..registry import aggregate_facts, aggregate_registry
    hull = aggregate_registry(_registry_snapshots(spark, sf_dir),
                              excluded_regions=EXCLUDED_NATIONS)
    kinds = _registry_kinds(spark, sf_dir)
    o = table(spark, sf_dir, "orders")
    rev = aggregate_facts(o.select(
        F.col("o_custkey").cast("string").alias("org_tin"), "o_orderkey",
        F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)).alias("data_date"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.to_date("o_orderdate"))
         .alias("doc_date"),
        F.col("o_totalprice").alias("revenue")), ["revenue"], kinds, tiebreak=["o_orderkey"])
    li = table(spark, sf_dir, "lineitem")
    emp_rows = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        F.col("o_custkey").cast("string").alias("org_tin"), "l_orderkey", "l_linenumber",
        F.make_date(F.year("l_shipdate"), F.lit(12), F.lit(31)).alias("data_date"),
        F.to_date("l_shipdate").alias("doc_date"),
        F.col("l_quantity").cast("int").alias("employees_count"))
    # lineitem restates (orderkey, linenumber): the count itself breaks the
    # last ties, so the pick is deterministic.
    emp = aggregate_facts(emp_rows.withColumn("_n", F.col("employees_count")),
                          ["employees_count"], kinds,
                          tiebreak=["l_orderkey", "l_linenumber", "_n"])
    panel = panelize(hull, [rev, emp])
    return panel.select("tin", "reg_number", "district_name",
                        iso_date("start_date").alias("start_date"),
                        F.col("year").cast("long").alias("year"), "revenue",
                        F.col("employees_count").cast("long").alias("employees_count"))
