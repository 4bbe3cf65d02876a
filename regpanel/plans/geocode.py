"""Georeference registry intervals through the address waterfall.

Where the source pipeline walked the data in single-process chunks of a
million rows, this is one Spark plan:

1. the *distinct* address tuples are normalised -- type abbreviations
   expanded (J3), name+type composed (P10), region resolved (J8), text
   canonicalised (P12);
2. the 14-pass waterfall (J4) maps each address to a city or settlement
   against de-ambiguated, broadcast standards;
3. records join their address mapping (null-safe key), then the conformed
   geodata (J6/R4); region = geodata region else the address region (P14),
   normalised again (J8); federal cities fill their settlement (P13);
4. duplicates created by geocoding collapse (W4).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..assets.fixed import (ADDRESS_COLUMNS, ADDRESS_PARTS, AREA_RULES,  # noqa: F401
                            CITY_MARKER, DEDUPE_COLUMNS, FEDERAL_CITIES, FUZZY_THRESHOLD,
                            PRODUCT_COLUMNS, REGION_TYPE_WORDS, WATERFALL)
from ..functions.text import canonical_text, join_name_and_type
from ..operators.dedupe import broadcast_if_bounded, broadcast_materialized
from ..operators.intervals import hull_last_end
from ..operators.keys import fill_when_null_and_in
from ..operators.matching import MatchPass, dictionary_lookup, waterfall_match
from ..operators.regions import apply_region_mapping, region_mapping
from ..operators.reshape import cities_standard, joint_geodata
from ..session import cut_lineage


ADDRESS_BROADCAST_ROWS = 250_000


def _canon(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: canonical_text(c) for c in columns})


def compose_addresses(addresses: DataFrame, abbreviations: DataFrame,
                      prepend_types: Sequence[str] = ()) -> DataFrame:
    """Step 1 on distinct address tuples: keeps the raw columns (as
    ``_raw_*``, the join key back to the records), expands the types and adds the composed
    parts."""
    df = addresses.select(*ADDRESS_COLUMNS,
                          *[F.col(c).alias(f"_raw_{c}") for c in ADDRESS_COLUMNS])
    for part in ADDRESS_PARTS:
        df = dictionary_lookup(df, f"{part}_type", abbreviations)
        df = df.withColumn(part, join_name_and_type(f"{part}_name", f"{part}_type",
                                                    prepend_types))
    return df


def known_regions(composed: DataFrame, cities: DataFrame, settlements: DataFrame,
                  regions: DataFrame) -> DataFrame:
    """Every region value that the geocoder resolves, before and after the waterfall: those of
    the addresses and the gazetteer, and the canonical text of the names they resolve to."""
    value = F.col("region").alias("v")
    return (composed.select(value).unionByName(cities.select(value)).unionByName(settlements.select(value))
            .unionByName(regions.select(canonical_text("name").alias("v"))))


def settlements_standard(settlements: DataFrame, abbreviations: DataFrame,
                         mapping: DataFrame) -> DataFrame:
    std = settlements.select("id", "region", "municipality", "settlement", "type")
    std = dictionary_lookup(std, "type", abbreviations)
    std = apply_region_mapping(std, "region", mapping)
    return _canon(std, ["region", "municipality", "settlement", "type"])


def city_standard(cities: DataFrame, mapping: DataFrame) -> DataFrame:
    std = cities_standard(cities, city_area_type=CITY_MARKER)
    return _canon(apply_region_mapping(std, "region", mapping), ["region", "area", "city", "settlement"])


def geocode(records: DataFrame, cities: DataFrame, settlements: DataFrame,
            regions: DataFrame, abbreviations: DataFrame,
            prepend_types: Sequence[str] = ()) -> DataFrame:
    """Aggregated registry intervals -> geocoded intervals
    (``PRODUCT_COLUMNS``). ``cities`` / ``settlements`` carry a unique
    ``id``; ``abbreviations`` is ``(name, name_full)`` as built by
    ``operators.matching.abbreviation_dictionary``; ``regions`` is
    ``(_row, code, name, short_name, iso_code)``."""
    # Distinct address tuples, written once: both the region lookup and the
    # waterfall read them, and the wide records are scanned only here and
    # in the final join.
    # The abbreviation dictionary is derived (three variants, first wins):
    # compute it once; every lookup then reads the small written table.
    abbreviations = broadcast_materialized(abbreviations)
    addresses = records.select(*ADDRESS_COLUMNS).distinct()
    composed = cut_lineage(compose_addresses(addresses, abbreviations, prepend_types))
    # One lookup for all region values there are, in place of one per table.
    found = region_mapping(known_regions(composed, cities, settlements, regions), regions, REGION_TYPE_WORDS, FUZZY_THRESHOLD)
    addr = _canon(apply_region_mapping(composed, "region", found),
                  ADDRESS_COLUMNS + ADDRESS_PARTS + ["region_code", "region_iso_code"])
    # Standards feed 14 passes and their size checks: write them once (they
    # are dimension-sized).
    standards = {"s": cut_lineage(settlements_standard(settlements, abbreviations, found)),
                 "c": cut_lineage(city_standard(cities, found))}
    passes = [MatchPass(n, left, right, std, tag=std) for n, left, right, std in WATERFALL]
    mapped = waterfall_match(addr, standards, passes, id_col="id", out_id="geo_id",
                             out_type="type")
    mapping = mapped.select(*[f"_raw_{c}" for c in ADDRESS_COLUMNS], "geo_id", "type",
                            F.col("region").alias("_addr_region"))
    # One row per distinct address (eight text columns wide): written once,
    # broadcast only up to ADDRESS_BROADCAST_ROWS (~100 MB), else joined by
    # a shuffle -- the records side is the big one either way.
    mapping = broadcast_materialized(mapping, max_rows=ADDRESS_BROADCAST_ROWS)

    # Records -> their address mapping (null-safe on all address parts).
    cond = reduce(lambda a, b: a & b, [records[c].eqNullSafe(mapping[f"_raw_{c}"])
                                       for c in ADDRESS_COLUMNS])
    rec = records.drop("region_code").join(mapping, cond, "left") \
                 .drop(*ADDRESS_COLUMNS, *[f"_raw_{c}" for c in ADDRESS_COLUMNS])
    geo = joint_geodata(cities, settlements, AREA_RULES, CITY_MARKER, CITY_MARKER)
    geo = broadcast_if_bounded(geo.withColumnRenamed("region", "_geo_region"))
    rec = rec.join(geo, ["geo_id", "type"], "left")
    rec = rec.withColumn("region", F.coalesce("_geo_region", "_addr_region"))
    rec = apply_region_mapping(rec, "region", found)
    rec = fill_when_null_and_in(rec, "settlement", "region", FEDERAL_CITIES)
    rec = rec.select(*PRODUCT_COLUMNS)
    # Equal starts: the larger end wins (the source left the tie open).
    return hull_last_end(rec, DEDUPE_COLUMNS, "start_date", "end_date", carry=[],
                         tiebreak=["end_date"])\
        .select(*PRODUCT_COLUMNS)
