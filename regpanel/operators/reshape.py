"""Reshape and set operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_area_and_type


def union_all(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union by column name (missing columns become null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing),
                  list(frames))


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
            var: str = "variable", val: str = "value") -> DataFrame:
    """R2: unpivot ``values`` columns into ``(var, val)`` rows (pandas melt)."""
    return df.unpivot(list(ids), list(values), var, val)


def to_wide(df: DataFrame, index: Sequence[str], column: str, value: str,
            values: Sequence | None = None) -> DataFrame:
    """Pivot ``column`` into columns holding ``value`` (pandas unstack).

    Pass ``values`` to fix the output columns (no extra job to find them).
    """
    g = df.groupBy(*index)
    p = g.pivot(column, list(values)) if values is not None else g.pivot(column)
    return p.agg(F.first(value))


# ------------------------------------------------------------------ R5
def cities_standard(cities: DataFrame, id_col: str = "id", region: str = "region",
                    area: str = "area", area_type: str = "area_type",
                    city: str = "city", settlement: str = "settlement",
                    city_area_type: str = "г") -> DataFrame:
    """The city matching standard: every city row, plus a copy of each row
    whose area is itself a city (``area_type`` = city marker, no city) with
    the area moved to the city column."""
    base = cities.select(id_col, region, area, city, settlement)
    moved = (cities.filter((F.col(area_type) == city_area_type) & F.col(city).isNull())
                   .select(id_col, region, F.lit(None).cast("string").alias(area),
                           F.col(area).alias(city), settlement))
    return base.unionByName(moved)


# ------------------------------------------------------------------ R4
def joint_geodata(cities: DataFrame, settlements: DataFrame,
                  area_rules: Sequence[tuple[str, str, str]],
                  city_area_type: str = "г", city_settlement_type: str = "г",
                  city_tag: str = "c", settlement_tag: str = "s") -> DataFrame:
    """R4 (+ P11, P14, P19): conform the city and settlement dimensions to
    one column set ``geo_id, type, region, area, settlement,
    settlement_type, oktmo, lat, lon`` tagged by source.

    Cities: settlement falls back to city then area; an area that is itself
    a city is cleared; the area is rendered with its type; the settlement
    type is the city marker.
    """
    c = cities
    c_area = F.when(F.col("area_type") == city_area_type, F.lit(None)).otherwise(F.col("area"))
    c = c.select(
        F.col("id").alias("geo_id"), F.lit(city_tag).alias("type"), "region",
        join_area_and_type(c_area, F.col("area_type"), area_rules).alias("area"),
        F.coalesce("settlement", "city", "area").alias("settlement"),
        F.lit(city_settlement_type).alias("settlement_type"), "oktmo",
        F.col("geo_lat").alias("lat"), F.col("geo_lon").alias("lon"))
    s = settlements.select(
        F.col("id").alias("geo_id"), F.lit(settlement_tag).alias("type"), "region",
        F.col("municipality").alias("area"), "settlement",
        F.col("type").alias("settlement_type"), "oktmo",
        F.col("latitude_dd").alias("lat"), F.col("longitude_dd").alias("lon"))
    return c.unionByName(s)
