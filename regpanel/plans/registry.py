"""Registry snapshots -> validity intervals; yearly filings -> one
latest revision per entity-year, restricted to legal entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..assets.fixed import EXCLUDED_REGIONS, OUTPUT_COLUMNS, STATE_COLUMNS, UPPER_COLUMNS
from ..operators.intervals import latest_revision, next_known_fill, state_hull
from ..operators.keys import entity_key, exclude_substrings, upper_columns


def aggregate_registry(snapshots: DataFrame,
                       excluded_regions: Sequence[str] = tuple(EXCLUDED_REGIONS),
                       state_columns: Sequence[str] = tuple(STATE_COLUMNS),
                       upper: Sequence[str] = tuple(UPPER_COLUMNS),
                       fill_method: str = "bucketed") -> DataFrame:
    """Registry snapshots -> one row per distinct entity state with
    ``[start_date, end_date]`` (first and last snapshot date of that state).

    P4 exclusion (null region drops the row) -> P5 upper -> P6/P7 keys ->
    W1 registration number filled from the next known snapshot of the
    entity -> W2 hull over the state columns (columns outside the state,
    such as types and the region code, come from the earliest snapshot).
    """
    df = exclude_substrings(snapshots, "region_name", [r.upper() for r in excluded_regions])
    df = upper_columns(df, upper)
    df = entity_key(df, "ind_tin", "org_tin", person_reg="ind_number",
                    org_reg="org_number")
    # Snapshots of one day are ordered by a deterministic tie-break (the
    # source left it open): ``_snap`` when given, else the extraction's
    # provenance (archive, member), then a hash of the row (an archive member
    # can hold many documents).
    if "_snap" in df.columns:
        tie = ["_snap"]
    elif "archive" in df.columns and "member" in df.columns:
        df = df.withColumn("_snap", F.concat_ws("/", "archive", "member"))
        tie = ["_snap"]
    else:
        tie = []
    carry = [c for c in OUTPUT_COLUMNS
             if c not in state_columns and c not in ("start_date", "end_date")]
    needed = list(dict.fromkeys([*state_columns, *carry, "data_date", *tie]))
    df = df.select(*needed).withColumn("_row_hash", F.xxhash64(*needed))
    tie = [*tie, "_row_hash"]
    df = next_known_fill(df, "tin", ["data_date"] + tie, "reg_number", method=fill_method)
    hull = state_hull(df, list(state_columns), "data_date", carry=carry, tiebreak=tie)
    return hull.select(*OUTPUT_COLUMNS)


def legal_entities(registry: DataFrame, kind_col: str = "kind",
                   key: str = "tin") -> DataFrame:
    """Keys of registry entities of kind 1 (legal entities)."""
    return registry.filter(F.col(kind_col) == 1).select(key)


def aggregate_facts(facts: DataFrame, measures: Sequence[str],
                    registry: DataFrame | None = None, id_col: str = "org_tin",
                    key: str = "tin", width: int = 10, period_col: str = "data_date",
                    revision_col: str = "doc_date", tiebreak: Sequence[str] = (),
                    year_col: str = "year") -> DataFrame:
    """Yearly filings -> ``key, year, measures...``.

    The semi join with the registry's legal entities runs *before* the
    revision dedupe (Catalyst would not push it below the aggregate), so
    the dedupe only sees rows that survive.
    """
    df = facts.withColumn(key, F.lpad(F.col(id_col).cast("string"), width, "0"))
    if registry is not None:
        df = df.join(legal_entities(registry, key=key), key, "left_semi")
    df = df.select(*dict.fromkeys([key, period_col, revision_col, *tiebreak, *measures]))
    latest = latest_revision(df, [key, period_col], revision_col, tiebreak)
    return latest.select(key, F.year(period_col).alias(year_col), *measures)
