"""Dimension / lookup table loaders with explicit schemas.

Dimensions are small by nature (an abbreviation list, the federal subjects,
towns and settlements of one country, an activity classifier). Three of them
need their *file order* (first-wins dictionaries, running ids): their rows are numbered
from 0 by ``sources.ordered``, the same whatever splits and partitions the scan has, and
written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .ordered import numbered_scans


def _str(*names):
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


ABBR_SCHEMA = _str("type_id", "fias_level", "name", "name_full")
CLASSIFIER_SCHEMA = _str("group", "code", "name")
SETTLEMENTS_SCHEMA = _str("id", "region", "municipality", "settlement", "type", "oktmo",
                          "longitude_dd", "latitude_dd")
CITY_COLUMNS = ["region", "area", "area_type", "city", "city_type", "settlement",
                "settlement_type", "oktmo", "geo_lat", "geo_lon"]


def _read(spark, path, schema=None):
    r = spark.read.options(header="true", escape='"')
    r = r.schema(schema) if schema is not None else r.option("inferSchema", "false")
    return r.csv(path)


def load_abbreviations(spark: SparkSession, path: str) -> DataFrame:
    """Abbreviation table ``name, name_full, _row`` (``_row`` = file order)."""
    df = numbered_scans([_read(spark, path, ABBR_SCHEMA)], "_row")
    return cut_lineage(df.select("name", "name_full", "_row"))


def load_regions(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Regions ``_row, code, name, short_name, iso_code``: the shipped fixed
    table, or a CSV with those columns."""
    if path is None:
        from ..assets.regions import regions_table
        return regions_table(spark)
    return cut_lineage(numbered_scans([_read(spark, path, _str("code", "name", "short_name", "iso_code"))], "_row"))


def load_cities(spark: SparkSession, *paths: str) -> DataFrame:
    """Cities from several CSVs (base, additional) by column name, with a
    running ``id`` from 0 in the order of paths, files and rows; a column that a file lacks is
    null; coordinates as doubles."""
    scans = []
    for p in paths:
        raw = _read(spark, p)
        scans.append(raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in CITY_COLUMNS]))
    df = numbered_scans(scans, "id")
    df = df.withColumns({"geo_lat": F.col("geo_lat").try_cast("double"),
                         "geo_lon": F.col("geo_lon").try_cast("double")})
    return cut_lineage(df)


def load_settlements(spark: SparkSession, path: str) -> DataFrame:
    df = _read(spark, path, SETTLEMENTS_SCHEMA)
    return df.withColumns({"longitude_dd": F.col("longitude_dd").try_cast("double"),
                           "latitude_dd": F.col("latitude_dd").try_cast("double")})


def load_classifier(spark: SparkSession, path: str) -> DataFrame:
    """Activity classifier ``group, code, name``; group header rows have a
    blank code (they never qualify in a code filter)."""
    return _read(spark, path, CLASSIFIER_SCHEMA)
