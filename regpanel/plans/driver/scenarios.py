"""Driver queries for hot keys, exact types, whole pipelines over plain tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import EXCLUDED_NATIONS, _customers_with_nation, iso_date, register, table

#: 2^53 + 1: the first integer that a double cannot hold.
BIG = 9007199254740993


# ------------------------------------------------------------ W1, hot key
@register("next_known_fill_hot", f"""
WITH l AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity,
         CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_partkey END AS k,
         CASE WHEN (l_orderkey + l_linenumber) % 4 = 0 THEN l_orderkey + {BIG} END AS big,
         CASE WHEN l_orderkey % 5 = 0 THEN NULL WHEN l_orderkey % 7 = 0 THEN CAST('NaN' AS DOUBLE)
              ELSE l_extendedprice END AS price
  FROM lineitem),
f AS (
  SELECT *, first_value(big IGNORE NULLS) OVER w AS big_filled, first_value(price IGNORE NULLS) OVER w AS price_filled
  FROM l WINDOW w AS (PARTITION BY k ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(big_filled AS VARCHAR) AS big_filled,
       isnan(price_filled) AS is_nan, CASE WHEN NOT isnan(price_filled) THEN price_filled END AS price_filled
FROM f
""")
def next_known_fill_hot_q(spark, sf_dir):
    """W1 with a third of the rows on one key: integers beyond 2^53 and NaN pass unchanged."""
    from ...operators.intervals import next_known_fill
    order = F.col("l_orderkey")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        F.when(order % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("l_partkey")).alias("k"),
        F.when((order + F.col("l_linenumber")) % 4 == 0, order + F.lit(BIG)).alias("big"),
        F.when(order % 5 == 0, F.lit(None)).when(order % 7 == 0, F.lit(float("nan")))
         .otherwise(F.col("l_extendedprice")).alias("price"))
    # Lines repeat (order, number); the other columns make the order unique.
    by = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    out = next_known_fill(rows, "k", by, "big", "big_filled")
    out = next_known_fill(out, "k", by, "price", "price_filled")
    return out.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                      F.col("big_filled").cast("string").alias("big_filled"),
                      F.when(F.col("price_filled").isNotNull(), F.isnan("price_filled")).alias("is_nan"),
                      F.when(~F.isnan("price_filled"), F.col("price_filled")).alias("price_filled"))


_TIED = ("CASE WHEN l_orderkey % 3 = 0 THEN TIMESTAMP '1996-01-01' ELSE CAST(l_shipdate AS TIMESTAMP) END AS day, "
         "'order-' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || '/' || CAST(l_linenumber AS VARCHAR) AS ref")


@register("next_known_fill_text", f"""
WITH l AS (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE 'part-' || CAST(l_partkey AS VARCHAR) END AS k, {_TIED},
                  CASE WHEN (l_orderkey + l_linenumber) % 4 = 0 THEN 'v' || CAST(l_suppkey AS VARCHAR) END AS v FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       first_value(v IGNORE NULLS) OVER (PARTITION BY k ORDER BY day, ref, l_partkey, l_suppkey, l_extendedprice, l_quantity
                                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS by_day,
       first_value(v IGNORE NULLS) OVER (PARTITION BY k ORDER BY ref, l_partkey, l_suppkey, l_extendedprice, l_quantity
                                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS by_ref
FROM l
""")
def next_known_fill_text_q(spark, sf_dir):
    """W1 with a third of the rows on one key, ordered by text, and by a day that all rows of the key share."""
    from ...operators.intervals import next_known_fill
    order = F.col("l_orderkey")
    hot = order % 3 == 0
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("part-"), F.col("l_partkey").cast("string"))).alias("k"),
        F.when(hot, F.lit("1996-01-01").cast("timestamp")).otherwise(F.col("l_shipdate").cast("timestamp")).alias("day"),
        F.concat(F.lit("order-"), F.lpad(order.cast("string"), 9, "0"), F.lit("/"), F.col("l_linenumber").cast("string")).alias("ref"),
        F.when((order + F.col("l_linenumber")) % 4 == 0, F.concat(F.lit("v"), F.col("l_suppkey").cast("string"))).alias("v"))
    by = ["ref", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    out = next_known_fill(rows, "k", ["day", *by], "v", "by_day")
    out = next_known_fill(out, "k", by, "v", "by_ref")
    return out.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "by_day", "by_ref")


# ------------------------------------------------------------ A12, native type
@register("spearman_large_integers", f"""
WITH d AS (SELECT o_orderpriority AS g, o_orderkey + {BIG} AS x, o_custkey AS y FROM orders),
r AS (SELECT g, rank() OVER (PARTITION BY g ORDER BY x) + (count(*) OVER (PARTITION BY g, x) - 1) / 2.0 AS rx,
             rank() OVER (PARTITION BY g ORDER BY y) + (count(*) OVER (PARTITION BY g, y) - 1) / 2.0 AS ry FROM d)
SELECT g, round(corr(rx, ry), 9) AS spearman, count(*) AS n FROM r GROUP BY g
""")
def spearman_large_integers_q(spark, sf_dir):
    """A12 on integers that differ by less than a double can tell."""
    from ...operators.quality import spearman
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("g"),
                                              (F.col("o_orderkey") + F.lit(BIG)).alias("x"), F.col("o_custkey").alias("y"))
    return spearman(o, "x", "y", ["g"]).select("g", F.round("spearman", 9).alias("spearman"), "n")


# ------------------------------------------------------------ C8
_YEARS = ("1996", "1997", "1998")


@register("validation_pipeline", """
WITH cn AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE n_name END AS region
            FROM customer JOIN nation ON c_nationkey = n_nationkey),
grp AS (SELECT *, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'H' ELSE 'L' END AS grp,
               CAST(year(o_orderdate) AS BIGINT) AS year FROM orders JOIN cn ON o_custkey = c_custkey),
snaps AS (SELECT * FROM grp WHERE region IS NOT NULL AND o_custkey % 13 <> 0
          AND region NOT ILIKE '%NATION_1%' AND region NOT ILIKE '%ATION_2%'),
reg AS (SELECT region, year, grp, sum(n) AS count_reestr
        FROM (SELECT region, year, grp, o_orderpriority, count(DISTINCT o_custkey) AS n FROM snaps GROUP BY ALL) GROUP BY ALL),
cells AS (SELECT DISTINCT region, grp FROM grp WHERE region IS NOT NULL),
stat AS (SELECT c.region, c.grp, y.year, coalesce(sum(CASE WHEN g.o_orderkey % 5 = 0 AND c.region <> 'NATION_3' THEN 1.0 END), 0.0) AS count_stat
         FROM cells c CROSS JOIN (SELECT unnest([1996, 1997, 1998]) AS year) y
         LEFT JOIN grp g ON g.region = c.region AND g.grp = c.grp AND g.year = y.year GROUP BY ALL)
SELECT r.region, CAST(r.year AS BIGINT) AS year, r.grp, CAST(r.count_reestr AS BIGINT) AS count_reestr, CAST(s.count_stat AS DOUBLE) AS count_stat,
       round((r.count_reestr - s.count_stat) / (r.count_reestr + s.count_stat), 9) AS norm_diff
FROM reg r JOIN stat s ON r.region = s.region AND r.year = s.year AND r.grp = s.grp
""")
def validation_pipeline_q(spark, sf_dir):
    """C8 end to end: excluded regions and rows without a region drop, persons drop, a
    region whose statistics are all missing counts as 0 (norm_diff 1)."""
    out = _validation_run(spark, sf_dir, F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "H").otherwise("L"), _YEARS)["table"]
    return out.select("region", F.col("year").cast("long").alias("year"), F.col("group").alias("grp"),
                      F.col("count_reestr").cast("long").alias("count_reestr"), "count_stat", F.round("norm_diff", 9).alias("norm_diff"))


def _validation_run(spark, sf_dir, group, years):
    """C8 over all orders: snapshots per nation, statistics per nation and ``group``, a column per year."""
    from ..validation import run_validation
    cn = _customers_with_nation(spark, sf_dir)
    key = F.col("c_custkey")
    orders = (table(spark, sf_dir, "orders").join(cn, F.col("o_custkey") == key)
              .withColumn("region_name", F.when(key % 11 == 0, F.lit(None)).otherwise(F.col("n_name"))))
    snaps = orders.select("region_name", F.when(key % 13 != 0, F.col("o_custkey")).alias("org_tin"), F.col("o_custkey").alias("ind_tin"),
                          F.to_date("o_orderdate").alias("data_date"), F.col("o_orderpriority").alias("activity_code_main"))
    codes = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("code"), F.col("o_orderpriority").alias("name"), group.alias("group")).distinct()
    headers = codes.select(F.lit(" ").alias("code"), F.concat(F.lit("all "), "group").alias("name"), "group").distinct()
    measured = F.when((F.col("o_orderkey") % 5 == 0) & (F.col("region_name") != "NATION_3"), F.lit(1.0))
    stats = (orders.where("region_name is not null")
             .groupBy("region_name", F.concat(F.lit("all "), group).alias("activity"))
             .agg(*[F.sum(F.when(F.year("o_orderdate") == int(y), measured)).alias(y) for y in years]))
    n = table(spark, sf_dir, "nation")
    regions = n.select(F.col("n_nationkey").alias("_row"), (F.col("n_nationkey") + 1000).cast("string").alias("code"), F.col("n_name").alias("name"),
                       F.col("n_name").alias("short_name"), F.concat(F.lit("ISO-"), F.col("n_nationkey").cast("string")).alias("iso_code"))
    return run_validation(snaps, stats, codes.unionByName(headers), regions, list(years), EXCLUDED_NATIONS)


#: Every year that the tables hold.
_ALL_YEARS = tuple(str(y) for y in range(1992, 2003))


def _correlations(name, keys, where="TRUE"):
    """SQL of the rank correlation of a and b per group of ``keys``."""
    by = ", ".join(keys)
    part = f"PARTITION BY {by} " if keys else ""
    tie = f"PARTITION BY {by}, " if keys else "PARTITION BY "
    rank = lambda x: f"rank() OVER ({part}ORDER BY {x}) + (count(*) OVER ({tie}{x}) - 1) / 2.0"
    return (f"{name} AS (SELECT {by + ', ' if by else ''}CASE WHEN isfinite(corr(ra, rb)) THEN corr(ra, rb) END AS v, count(*) AS n "
            f"FROM (SELECT *, {rank('a')} AS ra, {rank('b')} AS rb FROM m WHERE {where}){' GROUP BY ' + by if by else ''})")


def _description(name, source, column):
    """SQL rows of a description: one per statistic."""
    parts = {"count": f"CAST(count({column}) AS DOUBLE)", "mean": f"avg({column})", "std": f"stddev_samp({column})", "min": f"min({column})", "max": f"max({column})",
             **{f"{q}%": f"quantile_cont({column}, {q / 100})" for q in (25, 50, 75)}}
    return " UNION ALL ".join(f"SELECT '{name}' AS summary, NULL AS year, NULL AS region, NULL AS grp, '{k}' AS statistic, {e} AS value, NULL AS n FROM {source}" for k, e in parts.items())


def _summaries_sql():
    keep = "grp NOT IN ('O', 'P', 'R', 'U')"
    groups = {"overall": ([], "TRUE"), "by_year_region": (["year", "region"], keep), "by_year_group": (["year", "grp"], keep), "by_group": (["grp"], "TRUE"),
              "by_region_group": (["region", "grp"], "TRUE")}
    ctes = ",\n".join(_correlations(name, *g) for name, g in groups.items())
    rows = [f"SELECT '{name}' AS summary, {', '.join(k if k in keys else f'NULL AS {k}' for k in ('year', 'region', 'grp'))}, 'spearman' AS statistic, v AS value, n FROM {name}"
            for name, (keys, _) in groups.items()]
    rows += [_description("by_year_region_description", "by_year_region", "v"), _description("by_region_group_description", "by_region_group", "v"),
             _description("norm_diff", "m", "nd")]
    rows += [f"SELECT 'long' AS summary, year, region, grp, '{n}' AS statistic, CAST({c} AS DOUBLE) AS value, NULL AS n FROM m" for n, c in (("count_reestr", "a"), ("count_stat", "b"))]
    years = ", ".join(_ALL_YEARS)
    return f"""
WITH cn AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE n_name END AS region
            FROM customer JOIN nation ON c_nationkey = n_nationkey),
g AS (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B' WHEN '3-MEDIUM' THEN 'O' ELSE 'C' || right(o_orderpriority, 1) END AS grp,
             CAST(year(o_orderdate) AS BIGINT) AS year FROM orders JOIN cn ON o_custkey = c_custkey),
snaps AS (SELECT * FROM g WHERE region IS NOT NULL AND o_custkey % 13 <> 0 AND region NOT ILIKE '%NATION_1%' AND region NOT ILIKE '%ATION_2%'),
reg AS (SELECT region, year, grp, sum(n) AS a
        FROM (SELECT region, year, grp, o_orderpriority, count(DISTINCT o_custkey) AS n FROM snaps GROUP BY ALL) GROUP BY ALL),
cells AS (SELECT DISTINCT region, grp FROM g WHERE region IS NOT NULL),
stat AS (SELECT c.region, c.grp, y.year, coalesce(sum(CASE WHEN g.o_orderkey % 5 = 0 AND c.region <> 'NATION_3' THEN 1.0 END), 0.0) AS b
         FROM cells c CROSS JOIN (SELECT unnest([{years}]) AS year) y
         LEFT JOIN g ON g.region = c.region AND g.grp = c.grp AND g.year = y.year GROUP BY ALL),
m AS (SELECT r.region, r.year, r.grp, r.a, s.b, (r.a - s.b) / (r.a + s.b) AS nd FROM reg r JOIN stat s ON r.region = s.region AND r.year = s.year AND r.grp = s.grp),
{ctes}
SELECT summary, CAST(year AS BIGINT) AS year, region, grp, statistic, round(value, 9) AS value, CAST(n AS BIGINT) AS n FROM (
{" UNION ALL ".join(rows)})
"""


@register("validation_summaries", _summaries_sql())
def validation_summaries_q(spark, sf_dir):
    """C8's long form and its eight summaries (A11, A12) over the written comparison table of all years."""
    pri = F.col("o_orderpriority")
    group = (F.when(pri == "1-URGENT", "A").when(pri == "2-HIGH", "B").when(pri == "3-MEDIUM", "O")
             .otherwise(F.concat(F.lit("C"), F.substring(pri, -1, 1))))
    run = _validation_run(spark, sf_dir, group, _ALL_YEARS)

    def rows(name):
        df = run[name]
        if name == "long":
            df = df.withColumnsRenamed({"source": "statistic", "count": "value"})
        if "spearman" in df.columns:
            df = df.withColumn("statistic", F.lit("spearman")).withColumnRenamed("spearman", "value")
        have = lambda c, kind: F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind)
        return df.select(F.lit(name).alias("summary"), have("year", "long").alias("year"), have("region", "string").alias("region"), have("group", "string").alias("grp"),
                         "statistic", F.round(F.col("value").cast("double"), 9).alias("value"), have("n", "long").alias("n"))

    names = [n for n in run if n != "table"]
    out = rows(names[0])
    for name in names[1:]:
        out = out.unionByName(rows(name))
    return out


# ------------------------------------------------------------ P17, U2, R3
@register("override_values", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN 'tools' ELSE lower(c_mktsegment) END AS segment FROM customer
""")
def override_values_q(spark, sf_dir):
    """Manual overrides by exact match, everything else as it was."""
    from ...operators.keys import override_values
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.lower("c_mktsegment").alias("segment"))
    return override_values(c, "c_mktsegment", "segment", {"BUILDING": "construction", "MACHINERY": "tools"}).select("c_custkey", "segment")


@register("union_many", """
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS brand FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL FROM supplier
UNION ALL SELECT 'part', p_partkey, NULL, NULL, p_brand FROM part
""")
def union_many_q(spark, sf_dir):
    """Union of several tables by column name, missing columns as null."""
    from ...operators.reshape import union_all
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    p = table(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    return union_all([c, s, p])


@register("pivot_years", """
SELECT o_orderpriority, count(*) FILTER (year(o_orderdate) = 1995) AS y1995, count(*) FILTER (year(o_orderdate) = 1996) AS y1996,
       count(*) FILTER (year(o_orderdate) = 1997) AS y1997 FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY o_orderpriority
""")
def pivot_years_q(spark, sf_dir):
    """The wide table itself, one column per year."""
    from ...operators.reshape import to_wide
    o = table(spark, sf_dir, "orders").select("o_orderpriority", F.year("o_orderdate").alias("year")).where("year between 1995 and 1997")
    counts = o.groupBy("o_orderpriority", "year").agg(F.count(F.lit(1)).alias("n"))
    wide = to_wide(counts, ["o_orderpriority"], "year", "n", [1995, 1996, 1997])
    return wide.select("o_orderpriority", *[F.coalesce(F.col(str(y)), F.lit(0)).alias(f"y{y}") for y in (1995, 1996, 1997)])


# ------------------------------------------------------------ L1
@register("global_sort", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS o_orderdate,
       row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS position FROM orders
""")
def global_sort_q(spark, sf_dir):
    """L1: a sorted export read back: the files' order and the order in each
    file together are the global order."""
    from .common import _scratch
    out = _scratch(spark, "sorted")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    o.orderBy("o_orderdate", "o_orderkey").write.parquet(out)
    rows = spark.read.parquet(out).select("*", F.substring_index("_metadata.file_path", "/", -1).alias("file"), F.col("_metadata.row_index").alias("at"))
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    # One row per file of the export.
    before = sizes.select("file", F.expr("coalesce(sum(n) over (order by file rows between unbounded preceding and 1 preceding), 0)").alias("before"))
    return rows.join(before, "file").select("o_orderkey", iso_date("o_orderdate").alias("o_orderdate"), (F.col("before") + F.col("at")).alias("position"))


# ------------------------------------------------------------ S10, labelled form
@register("labelled_links", """
WITH p AS (SELECT page_id, url FROM pages WHERE page_id % 7 <> 0 AND page_id % 11 <> 0)
SELECT page_id, CAST(8 AS BIGINT) AS row, url || '/data.zip' AS link FROM p
UNION ALL SELECT page_id, 16, url || '/old-1.zip' FROM p
UNION ALL SELECT page_id, 16, url || '/old-2.zip' FROM p
""")
def labelled_links_q(spark, sf_dir):
    """S10 on the form of data-set pages, built from every page's url: every
    seventh has a wrong label, every eleventh lacks a row, others have two-cell rows,
    rows without a number, and anchors outside the table."""
    from ...sources.links import LABELLED_ROWS, labelled_links
    url, pid = F.col("url"), F.col("page_id")

    def row(number, label, value):
        return F.concat(F.lit(f"<tr><td> {number} </td><td>"), label, F.lit("</td><td>"), value, F.lit("</td></tr>"))

    def anchor(name):
        return F.concat(F.lit('<a class="x" href=" '), url, F.lit(f'/{name} ">zip</a>'))

    first = row(8, F.when(pid % 7 == 0, F.lit("?")).otherwise(F.lit(f"<b>{LABELLED_ROWS[8]}</b>")), anchor("data.zip"))
    older = F.when(pid % 11 == 0, F.lit("")).otherwise(row(16, F.lit(LABELLED_ROWS[16]), F.concat(anchor("old-1.zip"), F.lit("<br>"), anchor("old-2.zip"))))
    html = F.concat(F.lit('<a href="/no.zip">no</a><table class="wide border_table"><tr><td>8</td><td>two cells</td></tr>'), first,
                    row("n", F.lit("no number"), anchor("none.zip")), row(9, F.lit("other"), anchor("nine.zip")), older, F.lit("</table>"))
    pages = table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    return labelled_links(pages).select("page_id", F.col("row").cast("long").alias("row"), "link")
