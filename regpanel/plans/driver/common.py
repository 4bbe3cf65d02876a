"""Shared pieces of the driver adapters: the query registry, table access,
ISO rendering of dates, and derived views used by several query modules."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def iso_date(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def iso_ts(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# Snapshot view of orders: entity = customer, state = order priority.
def _order_snapshots(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("tin"),
                    F.col("o_orderpriority").alias("state"),
                    F.to_date("o_orderdate").alias("data_date"),
                    "o_orderkey", "o_totalprice")


# ------------------------------------------------------------ helpers
def _customers_with_nation(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner")


# Registry exclusion patterns on the driver nation names.
EXCLUDED_NATIONS = ["nation_1", "ATION_2"]


_KIND_SQL = "CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 1 ELSE 2 END"


def _registry_kinds(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("tin"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), 1).otherwise(2)
         .alias("kind"))


def _scratch(spark, name):
    import uuid
    from ...session import checkpoint_path
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
