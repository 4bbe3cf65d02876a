"""Interval tables -> entity-by-year panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.intervals import (attach_facts, expand_years, expand_years_open,
                                   yearly_latest)


def panelize(intervals: DataFrame, facts: Sequence[DataFrame | None] = (),
             key: str = "tin", start_col: str = "start_date",
             end_col: str = "end_date", year_col: str = "year",
             sort: bool = False) -> DataFrame:
    """Expand each interval record to its calendar years and left-join
    every available yearly fact table on (key, year).

    Overlapping intervals of one key give several rows per (key, year); use
    ``yearly_panel`` for one row per key-year with a confidence.
    ``sort=True`` adds the reference's global (key, year) order (a range
    shuffle: only ask for it when the consumer needs ordered files).
    """
    panel = expand_years(intervals, start_col, end_col, year_col)
    panel = attach_facts(panel, list(facts), on=(key, year_col))
    if sort:
        panel = panel.orderBy(key, year_col)
    return panel


def yearly_panel(intervals: DataFrame, key: str = "tin",
                 start_col: str = "start_date", end_col: str = "end_date",
                 year_col: str = "year", tiebreak: Sequence[str] = (),
                 drop_interval: bool = True) -> DataFrame:
    """One row per (key, year) -- the latest-starting record overlapping
    the year -- with ``confidence = 1 / overlapping records``."""
    expanded = expand_years_open(intervals, start_col, end_col, year_col)
    out = yearly_latest(expanded, key, year_col, start_col, tiebreak)
    if drop_interval:
        out = out.drop(start_col, end_col)
    return out
