"""Region resolution by free-form name or code.

Order of attempts for each distinct non-empty key: a digits-only key is a
code (``"01"`` = ``1``); otherwise exact full name (case-insensitive), then
exact short name, then -- after removing type words -- the best fuzzy match
among short names with a score strictly above the threshold (ties: the
region that comes first in the lookup table). Anything else maps to a null
record.

Scale: only *distinct* keys are resolved (A8), then joined back (J8). The
lookup table is a dimension checked to be small and broadcast. The fuzzy
step never pairs every key with every region: candidates come from an
equi-join on shared character bigrams (q-gram blocking). For thresholds of
70 and up this is exact: two strings whose edit similarity exceeds 70 share
at least one bigram (count filter: an edit destroys at most two bigrams).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_digits, similarity, strip_words
from .dedupe import broadcast_materialized, is_bounded

MIN_BLOCKING_THRESHOLD = 70.0


def bigrams(c: Column) -> Column:
    """Distinct character bigrams of a string; a 1-char string is its own
    token; an empty string has none."""
    n = F.length(c)
    grams = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(c, i, 2))
    return (F.when(n >= 2, F.array_distinct(grams))
             .when(n == 1, F.array(c))
             .otherwise(F.array().cast("array<string>")))


def resolve_names(keys: DataFrame, key_col: str, regions: DataFrame,
                  type_words: Sequence[str] = (), threshold: float = 80.0,
                  code_col: str = "code", name_col: str = "name",
                  short_col: str = "short_name", order_col: str = "_row",
                  broadcast_rows: int = 100_000) -> DataFrame:
    """J7 on a table of distinct keys -> ``key_col, _rid`` (``_rid`` = the
    matched region's ``order_col``, null when unresolved)."""
    if threshold < MIN_BLOCKING_THRESHOLD:
        raise ValueError("bigram blocking is exact only for thresholds >= 70")
    reg = regions.select(F.col(order_col).alias("_rid"),
                         F.col(code_col).cast("string").alias("_code"),
                         F.lower(F.col(name_col)).alias("_lname"),
                         F.lower(F.col(short_col)).alias("_lshort"))
    # Every lookup below derives from the regions table: broadcast them only
    # when that table is proven small, else leave the choice to the planner.
    small = is_bounded(regions, broadcast_rows)

    def bc(df):
        return F.broadcast(df) if small else df

    k = keys.select(key_col).filter(F.col(key_col).isNotNull() & (F.col(key_col) != ""))
    k = k.withColumns({"_lk": F.lower(F.col(key_col)),
                       "_digits": is_digits(F.col(key_col))})

    # Duplicate index entries: the later table row wins (a dict overwrite).
    def index(col):
        return reg.groupBy(col).agg(F.max("_rid").alias("_rid"))

    by_code = index("_code").select(F.col("_code").try_cast("long").alias("_ci"),
                                    F.col("_rid").alias("_r_code"))
    by_name = index("_lname").select(F.col("_lname").alias("_ni"),
                                     F.col("_rid").alias("_r_name"))
    by_short = index("_lshort").select(F.col("_lshort").alias("_si"),
                                       F.col("_rid").alias("_r_short"))
    k = (k.join(bc(by_code),
                F.col("_digits") & (F.col(key_col).try_cast("long") == F.col("_ci")), "left")
          .join(bc(by_name), (~F.col("_digits")) & (F.col("_lk") == F.col("_ni")), "left")
          .join(bc(by_short), (~F.col("_digits")) & (F.col("_lk") == F.col("_si")), "left"))
    exact = F.when(F.col("_digits"), F.col("_r_code")).otherwise(
        F.coalesce(F.col("_r_name"), F.col("_r_short")))
    k = k.select(key_col, "_lk", "_digits", exact.alias("_r_exact"))

    # Fuzzy residue: stripped key vs short names, candidates by shared bigram.
    residue = (k.filter(F.col("_r_exact").isNull() & ~F.col("_digits"))
                .select(key_col, strip_words(F.col("_lk"), type_words).alias("_q")))
    rq = residue.select(key_col, "_q", F.explode(bigrams(F.col("_q"))).alias("_bg"))
    shorts = bc(
        reg.groupBy("_lshort").agg(F.min("_rid").alias("_first_rid"),
                                   F.max("_rid").alias("_last_rid"))
           .select("_lshort", "_first_rid", "_last_rid",
                   F.explode(bigrams(F.col("_lshort"))).alias("_bg")))
    cand = (rq.join(shorts, "_bg")
              .select(key_col, "_q", "_lshort", "_first_rid", "_last_rid")
              .dropDuplicates([key_col, "_lshort"]))
    cand = cand.withColumn("_score", similarity(F.col("_q"), F.col("_lshort")))
    best = (cand.filter(F.col("_score") > threshold)
                .groupBy(key_col)
                .agg(F.max_by(F.col("_last_rid"),
                              F.struct(F.col("_score"), -F.col("_first_rid"))).alias("_r_fuzzy")))
    return (k.join(best, key_col, "left")
             .select(key_col, F.coalesce("_r_exact", "_r_fuzzy").alias("_rid")))


def region_mapping(values: DataFrame, regions: DataFrame, type_words: Sequence[str] = (),
                   threshold: float = 80.0, code_col: str = "code", name_col: str = "name",
                   short_col: str = "short_name", iso_col: str = "iso_code", order_col: str = "_row",
                   materialize: bool = True) -> DataFrame:
    """J7 + A8 for all values of a one-column table: ``_key`` (each distinct value), ``_rn, _rc, _ri``
    (the region's name, code and ISO code). Written once, and broadcast when it proved small."""
    key = values.columns[0]
    mapping = resolve_names(values.distinct(), key, regions, type_words, threshold, code_col, name_col,
                            short_col, order_col)
    info = regions.select(F.col(order_col).alias("_rid"), F.col(name_col).alias("_rn"),
                          F.col(code_col).cast("string").alias("_rc"), F.col(iso_col).alias("_ri"))
    # ``info`` is a projection of ``regions``: same row count, same bound.
    info = F.broadcast(info) if is_bounded(regions) else info
    mapping = mapping.join(info, "_rid", "left").select(F.col(key).alias("_key"), "_rn", "_rc", "_ri")
    return broadcast_materialized(mapping) if materialize else mapping


def apply_region_mapping(df: DataFrame, column: str, mapping: DataFrame, out_name: str | None = None,
                         out_code: str = "region_code", out_iso: str = "region_iso_code") -> DataFrame:
    """``column`` replaced by the mapped region name, with its code and ISO code; null for a
    value that is unresolved or not in the mapping. One row per key, so the row count holds."""
    out = df.join(mapping.withColumnRenamed("_key", column), on=column, how="left")
    return (out.withColumns({out_name or column: F.col("_rn"), out_code: F.col("_rc"), out_iso: F.col("_ri")})
               .drop("_rn", "_rc", "_ri"))


def normalize_regions(df: DataFrame, column: str, regions: DataFrame,
                      type_words: Sequence[str] = (), threshold: float = 80.0,
                      out_name: str | None = None, out_code: str = "region_code",
                      out_iso: str = "region_iso_code", code_col: str = "code",
                      name_col: str = "name", short_col: str = "short_name",
                      iso_col: str = "iso_code", order_col: str = "_row",
                      materialize: bool = True,
                      candidates: DataFrame | None = None) -> DataFrame:
    """Replace ``column`` by the canonical region name and add its code
    and ISO code; unresolved (or null) keys give nulls. The lookup runs once
    per distinct value, then joins back (row count unchanged). ``candidates``
    (one column) may supply a superset of the values to resolve, so the (possibly
    expensive) input is not scanned twice."""
    values = (candidates if candidates is not None else df).select(
        F.col(candidates.columns[0] if candidates is not None else column).alias("_value"))
    mapping = region_mapping(values, regions, type_words, threshold, code_col, name_col, short_col, iso_col,
                             order_col, materialize)
    return apply_region_mapping(df, column, mapping, out_name, out_code, out_iso)
