"""Profiling and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import _customers_with_nation, register, table


# ------------------------------------------------------------ A1 / A4
@register("distinct_group_counts", """
SELECT l_returnflag, l_linestatus, CAST(year AS BIGINT) AS year, count(*) AS n
FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey, year(l_shipdate) AS year
      FROM lineitem)
GROUP BY l_returnflag, l_linestatus, year
""")
def distinct_group_counts_q(spark, sf_dir):
    """A1 + A4: distinct (flag, status, supplier, year), then count per group."""
    from ...operators.dedupe import distinct_rows
    from ...operators.quality import group_counts
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_suppkey",
        F.year("l_shipdate").cast("long").alias("year"))
    out = group_counts(distinct_rows(li), ["l_returnflag", "l_linestatus", "year"], "n")
    return out.withColumn("n", F.col("n").cast("long"))


# ------------------------------------------------------------ A10
_NULLY_EVENTS_SQL = """
v AS (SELECT event_id, ts, user_id,
             CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type,
             CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value,
             CASE WHEN user_id % 5 = 0 THEN NULL ELSE props END AS props
      FROM events)"""


@register("null_profile", f"""
WITH {_NULLY_EVENTS_SQL}
SELECT 'event_id' AS column_name, count(*) FILTER (WHERE event_id IS NULL) AS null_count, count(*) AS row_count FROM v
UNION ALL SELECT 'ts', count(*) FILTER (WHERE ts IS NULL), count(*) FROM v
UNION ALL SELECT 'user_id', count(*) FILTER (WHERE user_id IS NULL), count(*) FROM v
UNION ALL SELECT 'event_type', count(*) FILTER (WHERE event_type IS NULL), count(*) FROM v
UNION ALL SELECT 'value', count(*) FILTER (WHERE value IS NULL), count(*) FROM v
UNION ALL SELECT 'props', count(*) FILTER (WHERE props IS NULL), count(*) FROM v
""")
def null_profile_q(spark, sf_dir):
    """A10: nulls per column in one pass."""
    from ...operators.quality import null_profile
    e = table(spark, sf_dir, "events")
    v = e.select("event_id", "ts", "user_id",
                 F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("event_type"))
                  .alias("event_type"),
                 F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("value"))
                  .alias("value"),
                 F.when(F.col("user_id") % 5 == 0, F.lit(None)).otherwise(F.col("props"))
                  .alias("props"))
    p = null_profile(v)
    return p.select(F.col("column").alias("column_name"),
                    F.col("null_count").cast("long").alias("null_count"),
                    F.col("row_count").cast("long").alias("row_count"))


# ------------------------------------------------------------ A11
@register("describe_stats", """
SELECT o_orderstatus, statistic, round(value, 4) AS value FROM (
  SELECT o_orderstatus, 'count' AS statistic, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1
  UNION ALL SELECT o_orderstatus, 'mean', avg(o_totalprice) FROM orders GROUP BY 1
  UNION ALL SELECT o_orderstatus, 'std', stddev_samp(o_totalprice) FROM orders GROUP BY 1
  UNION ALL SELECT o_orderstatus, 'min', min(o_totalprice) FROM orders GROUP BY 1
  UNION ALL SELECT o_orderstatus, '25%', quantile_cont(o_totalprice, 0.25) FROM orders GROUP BY 1
  UNION ALL SELECT o_orderstatus, '50%', quantile_cont(o_totalprice, 0.5) FROM orders GROUP BY 1
  UNION ALL SELECT o_orderstatus, '75%', quantile_cont(o_totalprice, 0.75) FROM orders GROUP BY 1
  UNION ALL SELECT o_orderstatus, 'max', max(o_totalprice) FROM orders GROUP BY 1)
""")
def describe_stats_q(spark, sf_dir):
    """describe() statistics per order status, exact quartiles."""
    from ...operators.quality import describe
    o = table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice")
    d = describe(o, "o_totalprice", ["o_orderstatus"])
    return d.select("o_orderstatus", "statistic", F.round("value", 4).alias("value"))


# ------------------------------------------------------------ A12 / R3
_SUPPLIER_YEAR_SQL = """
d AS (SELECT l_suppkey, year(l_shipdate) AS year, count(*) AS x, sum(l_quantity) AS y
      FROM lineitem GROUP BY l_suppkey, year(l_shipdate))"""


def _supplier_year(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_suppkey", F.year("l_shipdate").cast("long").alias("year"))
              .agg(F.count(F.lit(1)).alias("x"), F.sum("l_quantity").alias("y")))


@register("spearman_global", f"""
WITH {_SUPPLIER_YEAR_SQL},
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
      FROM d)
SELECT round(corr(rx, ry), 9) AS spearman, count(*) AS n FROM r
""")
def spearman_global_q(spark, sf_dir):
    """Spearman correlation of lines vs quantity per supplier-year."""
    from ...operators.quality import spearman
    s = spearman(_supplier_year(spark, sf_dir), "x", "y")
    return s.select(F.round("spearman", 9).alias("spearman"), F.col("n").cast("long").alias("n"))


@register("spearman_by_group", f"""
WITH {_SUPPLIER_YEAR_SQL},
r AS (SELECT year,
             rank() OVER (PARTITION BY year ORDER BY x)
               + (count(*) OVER (PARTITION BY year, x) - 1) / 2.0 AS rx,
             rank() OVER (PARTITION BY year ORDER BY y)
               + (count(*) OVER (PARTITION BY year, y) - 1) / 2.0 AS ry
      FROM d)
SELECT CAST(year AS BIGINT) AS year, round(corr(rx, ry), 9) AS spearman, count(*) AS n
FROM r GROUP BY year
""")
def spearman_by_group_q(spark, sf_dir):
    """A12 per group (year)."""
    from ...operators.quality import spearman
    s = spearman(_supplier_year(spark, sf_dir), "x", "y", ["year"])
    return s.select("year", F.round("spearman", 9).alias("spearman"),
                    F.col("n").cast("long").alias("n"))


# ------------------------------------------------------------ C8 / J10 / P16-P18
_VALIDATION_SQL = """
cls AS (SELECT DISTINCT o_orderpriority AS code,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'H' ELSE 'L' END AS grp
        FROM orders),
reestr0 AS (
  SELECT region, year, activity, count(*) AS cnt FROM (
    SELECT DISTINCT n.n_name AS region, o.o_custkey AS tin, year(o.o_orderdate) AS year,
                    o.o_orderpriority AS activity
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                  JOIN nation n ON c.c_nationkey = n.n_nationkey)
  GROUP BY region, year, activity),
reestr AS (SELECT region, year, grp, sum(cnt) AS count_reestr
           FROM reestr0 r JOIN cls ON r.activity = cls.code GROUP BY region, year, grp),
stat AS (
  SELECT n.n_name AS region, year(l.l_shipdate) AS year, cls.grp,
         count(DISTINCT l.l_orderkey) AS count_stat
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN customer c ON o.o_custkey = c.c_custkey
                  JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN cls ON o.o_orderpriority = cls.code
  WHERE n.n_name NOT IN ('NATION_3')
  GROUP BY n.n_name, year(l.l_shipdate), cls.grp)"""


def _validation_stats(spark, sf_dir):
    from ..validation import compare, counts_by_group, registry_counts
    o = table(spark, sf_dir, "orders")
    cn = _customers_with_nation(spark, sf_dir)
    pri = F.col("o_orderpriority")
    cls = o.select(pri.alias("code"),
                   F.when(pri.isin("1-URGENT", "2-HIGH"), "H").otherwise("L").alias("group")
                   ).distinct()
    oc = o.join(cn, o["o_custkey"] == cn["c_custkey"])
    snaps = oc.select("n_name", F.col("o_custkey").alias("tin"),
                      F.to_date("o_orderdate").alias("data_date"), pri.alias("activity"))
    reestr = registry_counts(snaps, region="n_name", activity="activity")
    reestr = counts_by_group(reestr, cls).withColumnRenamed("count", "count_reestr")
    li = table(spark, sf_dir, "lineitem")
    stat = (li.join(oc, li["l_orderkey"] == oc["o_orderkey"])
              .join(cls, pri == cls["code"])
              .filter(~F.col("n_name").isin("NATION_3"))
              .select(F.col("n_name").alias("region"), F.year("l_shipdate").alias("year"),
                      "group", "l_orderkey")
              .distinct()
              .groupBy("region", "year", "group").agg(F.count(F.lit(1)).alias("count_stat")))
    m = compare(reestr, stat)
    return m.withColumnRenamed("group", "grp").withColumn("year", F.col("year").cast("long"))


@register("norm_diff_validation", f"""
WITH {_VALIDATION_SQL}
SELECT r.region, CAST(r.year AS BIGINT) AS year, r.grp,
       CAST(r.count_reestr AS BIGINT) AS count_reestr, CAST(s.count_stat AS BIGINT) AS count_stat,
       round((r.count_reestr - s.count_stat) / (r.count_reestr + s.count_stat), 9) AS norm_diff
FROM reestr r JOIN stat s ON r.region = s.region AND r.year = s.year AND r.grp = s.grp
""")
def norm_diff_validation_q(spark, sf_dir):
    """Registry counts (distinct entities per region-year-activity,
    remapped to groups) vs an independent count; normalised difference."""
    m = _validation_stats(spark, sf_dir)
    return m.select("region", "year", "grp",
                    F.col("count_reestr").cast("long").alias("count_reestr"),
                    F.col("count_stat").cast("long").alias("count_stat"),
                    F.round("norm_diff", 9).alias("norm_diff"))


@register("validation_long", f"""
WITH {_VALIDATION_SQL},
m AS (SELECT r.region, r.year, r.grp, r.count_reestr, s.count_stat
      FROM reestr r JOIN stat s ON r.region = s.region AND r.year = s.year AND r.grp = s.grp)
SELECT region, CAST(year AS BIGINT) AS year, grp, 'count_reestr' AS source,
       CAST(count_reestr AS BIGINT) AS count FROM m
UNION ALL
SELECT region, CAST(year AS BIGINT), grp, 'count_stat', CAST(count_stat AS BIGINT) FROM m
""")
def validation_long_q(spark, sf_dir):
    """R2: the validation table melted to (source, count) rows."""
    from ...operators.reshape import to_long
    m = _validation_stats(spark, sf_dir).select(
        "region", "year", "grp", F.col("count_reestr").cast("long").alias("count_reestr"),
        F.col("count_stat").cast("long").alias("count_stat"))
    return to_long(m, ["region", "year", "grp"], ["count_reestr", "count_stat"],
                   "source", "count")


# ------------------------------------------------------------ R3 / R2
def _priority_year_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return (o.groupBy("o_orderpriority", F.year("o_orderdate").cast("long").alias("year"))
             .agg(F.count(F.lit(1)).alias("n")))


@register("unpivot_years", """
SELECT o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n
FROM orders GROUP BY o_orderpriority, year(o_orderdate)
""")
def unpivot_years_q(spark, sf_dir):
    """R3 then R2: counts pivoted to one column per year (values found from
    the data), then melted back to rows; empty cells are dropped."""
    from ...operators.reshape import to_long, to_wide
    wide = to_wide(_priority_year_counts(spark, sf_dir), ["o_orderpriority"], "year", "n")
    years = [c for c in wide.columns if c != "o_orderpriority"]
    long = to_long(wide, ["o_orderpriority"], years, "year", "n")
    return long.filter(F.col("n").isNotNull()).select(
        "o_orderpriority", F.col("year").cast("long").alias("year"),
        F.col("n").cast("long").alias("n"))


# ------------------------------------------------------------ A13
@register("uniqueness_violations", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def uniqueness_violations_q(spark, sf_dir):
    """Keys that break uniqueness, with their multiplicity."""
    from ...operators.matching import uniqueness_violations
    li = table(spark, sf_dir, "lineitem")
    u = uniqueness_violations(li, ["l_orderkey", "l_linenumber"])
    return u.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                    F.col("n").cast("long").alias("n"))


@register("year_range", """
SELECT CAST(min(year(o_orderdate)) AS BIGINT) AS first_year,
       CAST(max(year(o_orderdate)) AS BIGINT) AS last_year, count(*) AS n
FROM orders
""")
def year_range_q(spark, sf_dir):
    """Global min / max year (one partial aggregate per task)."""
    o = table(spark, sf_dir, "orders")
    return o.agg(F.min(F.year("o_orderdate")).cast("long").alias("first_year"),
                 F.max(F.year("o_orderdate")).cast("long").alias("last_year"),
                 F.count(F.lit(1)).alias("n"))
