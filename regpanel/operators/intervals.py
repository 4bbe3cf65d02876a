"""Snapshot -> validity interval -> yearly panel operators.

All operators are ``DataFrame -> DataFrame`` and generic in column names.
Per-key reductions are written so that they reduce *before* the shuffle:
aggregates (``groupBy().agg``, with ``min_by`` / ``max_by`` over structs)
for hulls, and ``row_number() = 1`` for latest-revision picks, which Spark
plans with a partial WindowGroupLimit on the map side. A key that holds a
third of all rows thus reaches its reducer as one row per map task. The
unbounded-following windows of the source pipeline (quadratic per key) are
gone; order-dependent fills use the bucketed scans in ``scan``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in names]


def _rest(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


# --------------------------------------------------------------------- W2
def state_hull(df: DataFrame, keys: Sequence[str], date_col: str,
               start_col: str = "start_date", end_col: str = "end_date",
               carry: Sequence[str] | None = None,
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """Collapse rows with an equal state into ``[first date, last date]``.

    Hull, not islands: a state that comes back (A -> B -> A) keeps one
    interval spanning both stays. Null key parts group together. ``carry``
    columns (default: every other column) come from the earliest row, ties
    broken by ``tiebreak``.
    """
    keys = list(keys)
    carry = _rest(df, keys + [date_col]) if carry is None else list(carry)
    aggs = [F.min(date_col).alias(start_col), F.max(date_col).alias(end_col)]
    if carry:
        order = F.struct(F.col(date_col), *_cols(tiebreak))
        aggs.append(F.min_by(F.struct(*_cols(carry)), order).alias("_first"))
    out = df.groupBy(*keys).agg(*aggs)
    if carry:
        out = out.select(*keys, "_first.*", start_col, end_col)
    return out


# --------------------------------------------------------------------- W3
def latest_revision(df: DataFrame, keys: Sequence[str], revision_col: str,
                    tiebreak: Sequence[str] = (), method: str = "window") -> DataFrame:
    """Keep one row per ``keys``: the latest ``revision_col`` (nulls last),
    ties broken by ``tiebreak`` (descending). A group whose revisions are all
    null still yields one row.

    ``method="window"`` (default): ``row_number() = 1``, which Spark plans as
    a *partial* WindowGroupLimit before the shuffle and a final one after --
    each map task forwards at most one row per key, so a hot key is cut down
    map-side. ``method="aggregate"``: ``max_by(struct(row), struct(order))``,
    the same rows through a (sort-based) partial aggregate.
    """
    if method == "window":
        return latest_revision_window(df, keys, revision_col, tiebreak)
    keys = list(keys)
    rest = _rest(df, keys)
    rank = F.struct(F.col(revision_col).isNotNull(), F.col(revision_col),
                    *_cols(tiebreak))
    return (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*_cols(rest)), rank).alias("_row"))
              .select(*keys, "_row.*"))


def latest_revision_window(df: DataFrame, keys: Sequence[str], revision_col: str,
                           tiebreak: Sequence[str] = ()) -> DataFrame:
    """W3 in the literal ``row_number() = 1`` form (planned as WindowGroupLimit)."""
    order = [F.col(revision_col).desc_nulls_last()] + [F.col(c).desc() for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


# --------------------------------------------------------------------- W1
def next_known_fill(df: DataFrame, key: Sequence[str] | str, order: Sequence[str],
                    value_col: str, out_col: str | None = None,
                    method: str = "bucketed", buckets: int | None = None) -> DataFrame:
    """Replace each value by the first non-null value at or after the row.

    Within ``key`` ordered by ``order`` (which must be unique per key for a
    deterministic answer). Trailing nulls stay null; a NaN is a known value.

    ``method="bucketed"`` (default): every key is cut into order buckets
    (``scan``), so a hot key is filled by many tasks.
    ``method="window"``: a running window over the reversed order for every
    key (one task per key -- a hot key lands in one task). Both give equal rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    out_col = out_col or value_col
    if method == "window":
        w = (Window.partitionBy(*keys)
             .orderBy(*[F.col(c).desc() for c in order])
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.withColumn(out_col, F.last(value_col, ignorenulls=True).over(w))
    if method != "bucketed":
        raise ValueError(f"unknown method {method!r}")
    from .scan import bucketed_next_known
    return bucketed_next_known(df, keys, list(order), value_col, out_col, buckets)


# --------------------------------------------------------------------- W4
def hull_last_end(df: DataFrame, keys: Sequence[str], start_col: str = "start_date",
                  end_col: str = "end_date", carry: Sequence[str] | None = None,
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """Merge duplicate interval rows; start = earliest start, end = end of
    the *last-starting* row (not the max end). Other columns from the first row."""
    keys = list(keys)
    carry = _rest(df, keys + [start_col, end_col]) if carry is None else list(carry)
    order = F.struct(F.col(start_col), *_cols(tiebreak))
    aggs = [F.min(start_col).alias(start_col),
            F.max_by(F.col(end_col), order).alias(end_col)]
    if carry:
        aggs.append(F.min_by(F.struct(*_cols(carry)), order).alias("_first"))
    out = df.groupBy(*keys).agg(*aggs)
    if carry:
        out = out.select(*keys, "_first.*", start_col, end_col)
    return out


# --------------------------------------------------------------------- R1
def expand_years(df: DataFrame, start_col: str = "start_date",
                 end_col: str = "end_date", year_col: str = "year") -> DataFrame:
    """One row per calendar year in ``[year(start), year(end)]``.

    A null end gives no rows; an end before the start gives no rows (Spark's
    ``sequence`` would count down, so that case is filtered explicitly).
    """
    ys, ye = F.year(start_col), F.year(end_col)
    return (df.filter(ye >= ys)
              .withColumn(year_col, F.explode(F.sequence(ys, ye))))


# --------------------------------------------------------------------- J9
def expand_years_open(df: DataFrame, start_col: str = "start_date",
                      end_col: str = "end_date", year_col: str = "year") -> DataFrame:
    """Interval-overlap join with calendar years, as an equi-expansion.

    A record belongs to year Y unless it starts after Dec 31 of Y or ends
    before Jan 1 of Y; years run from the earliest start year to the latest
    end year of the whole table, and a null end is open up to that year.
    The latest end year is a scalar subquery (one value, no join).
    """
    last_year = df.agg(F.max(F.year(end_col))).scalar()
    ys = F.year(start_col)
    ye = F.least(F.coalesce(F.year(end_col), last_year), last_year)
    return (df.filter(ye >= ys)
              .withColumn(year_col, F.explode(F.sequence(ys, ye))))


# --------------------------------------------------------------------- W5
def yearly_latest(df: DataFrame, key: Sequence[str] | str, year_col: str = "year",
                  start_col: str = "start_date", tiebreak: Sequence[str] = (),
                  confidence_col: str = "confidence") -> DataFrame:
    """W5 + P18: one row per (key, year): the latest-starting record, with
    ``confidence = 1 / number of records of that key in that year``."""
    keys = ([key] if isinstance(key, str) else list(key)) + [year_col]
    rest = _rest(df, keys)
    order = F.struct(F.col(start_col), *_cols(tiebreak))
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("_n"),
                   F.max_by(F.struct(*_cols(rest)), order).alias("_row"))
              .select(*keys, "_row.*",
                      (F.lit(1.0) / F.col("_n")).alias(confidence_col)))


# --------------------------------------------------------------------- J2
def attach_facts(panel: DataFrame, facts: Sequence[DataFrame | None],
                 on: Sequence[str] = ("tin", "year")) -> DataFrame:
    """Left-join each available yearly fact table on ``on``."""
    out = panel
    for f in facts:
        if f is not None:
            out = out.join(f, on=list(on), how="left")
    return out
