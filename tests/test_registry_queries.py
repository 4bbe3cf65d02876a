"""The registry queries on small tables of the driver's schema, against their SQL: wide snapshots whose columns are all
derived, one customer with a third of the orders, nulls in what they are derived from."""

import os
import tempfile

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import rows
from regpanel.operators.intervals import next_known_fill

_TABLES = {
    "nation": "SELECT CAST(i AS INTEGER) AS n_nationkey, 'NATION_' || i AS n_name, CAST(i % 3 AS INTEGER) AS n_regionkey FROM range(9) t(i)",
    "customer": """SELECT i AS c_custkey, CASE WHEN i % 11 <> 5 THEN 'Customer#' || lpad(CAST(i AS VARCHAR), 9, '0') END AS c_name,
                          CAST(i * 7 % 9 AS INTEGER) AS c_nationkey, i * 1.5 AS c_acctbal,
                          CASE i % 4 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'AUTOMOBILE' WHEN 2 THEN 'FURNITURE' END AS c_mktsegment
                   FROM range(60) t(i)""",
    "orders": """SELECT i AS o_orderkey, CASE WHEN i % 3 = 0 THEN 9 WHEN i % 29 <> 1 THEN i * 13 % 70 END AS o_custkey,
                        CASE i % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'O' WHEN 2 THEN 'P' END AS o_orderstatus, i * 2.25 AS o_totalprice,
                        TIMESTAMP '1995-01-01' + to_days(CAST(i * 17 % 1500 AS INTEGER)) AS o_orderdate,
                        CASE WHEN i % 7 <> 3 THEN (ARRAY['1-URGENT', '2-HIGH', '3-MEDIUM'])[i * 5 % 3 + 1] END AS o_orderpriority
                 FROM range(900) t(i)""",
    "lineitem": """SELECT i % 900 AS l_orderkey, CAST(i // 900 AS INTEGER) AS l_linenumber, CAST(i % 50 AS DOUBLE) AS l_quantity,
                          TIMESTAMP '1995-03-01' + to_days(CAST(i * 19 % 1500 AS INTEGER)) AS l_shipdate FROM range(2000) t(i)""",
    "supplier": """SELECT i AS s_suppkey, 'Supplier#' || i AS s_name, CAST(i * 5 % 9 AS INTEGER) AS s_nationkey, i * 10.5 AS s_acctbal
                   FROM range(200) t(i)""",
}


@pytest.fixture(scope="module")
def small():
    d, con = tempfile.mkdtemp(prefix="registry-", dir="/tmp"), duckdb.connect()
    for name, sql in _TABLES.items():
        con.execute(f"COPY ({sql}) TO '{os.path.join(d, name)}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(d, name)}.parquet'")
    return d, con


def plain(v):
    return None if pd.isna(v) else round(float(v), 6) if isinstance(v, (int, float)) else v


def same_as_sql(spark, small, name):
    d, con = small
    got = E.queries()[name](spark, d)
    columns = sorted(got.columns)
    want = con.execute(E.oracle_sql()[name])
    at = [[x[0] for x in want.description].index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert len(want) > 50
    assert sorted((tuple(map(plain, r)) for r in got.select(*columns).collect()), key=repr) == want


def test_rows_are_drawn_above_the_projection_that_makes_the_order(spark):
    n = 8
    df = spark.range(600).select((F.col("id") % 5).cast("string").alias("k"), (F.col("id") * 7 % 600).cast("string").alias("t"),
                                 F.when(F.col("id") % 4 == 0, F.col("id")).alias("v"), *[F.concat(F.lit(f"c{i}-"), F.col("id") % (i + 2)).alias(f"c{i}") for i in range(n)])
    df = df.withColumns({f"c{i}": F.upper(f"c{i}") for i in range(n)})
    df = df.withColumn("h", F.xxhash64(*df.columns))
    got = next_known_fill(df, "k", ["t", "h"], "v", "f")
    # A filter over the derived columns, under their projection, gives 2^n constraints.
    filters = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter " in x]
    assert filters and not [x for x in filters if "upper(" in x]
    assert rows(got) == rows(next_known_fill(df, "k", ["t", "h"], "v", "f", method="window"))


def test_registry_hull_of_derived_columns(spark, small):
    same_as_sql(spark, small, "registry_hull")


def test_panel_of_registry_and_facts(spark, small):
    same_as_sql(spark, small, "panel_registry_facts")


def test_geocoded_registry(spark, small):
    same_as_sql(spark, small, "geocode_pipeline")
