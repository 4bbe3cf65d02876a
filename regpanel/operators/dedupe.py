"""Distinct / dedupe operators (A1-A3) and the bounded-broadcast helper."""

from __future__ import annotations

import weakref
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows and bytes a dimension may have to be broadcast (checked with a bounded action).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 128 << 20


_BOUND_CACHE: "weakref.WeakKeyDictionary[DataFrame, dict[tuple[int, int], bool]]" = weakref.WeakKeyDictionary()


def _row_bytes(df: DataFrame):
    """About the bytes of a row in memory: text at its length, any other value at 16."""
    text = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return reduce(lambda a, b: a + b, text, F.lit(16 * len(df.columns) + 16).cast("long"))


def is_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
               max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` provably has at most ``max_rows`` rows of together at most
    ``max_bytes``.

    The check reads at most ``max_rows + 1`` rows (``limit`` stops the
    scan), so it stays cheap even when the table turns out large. The answer
    is remembered per DataFrame object (a DataFrame is an immutable plan).
    """
    try:
        known = _BOUND_CACHE.setdefault(df, {})
    except TypeError:          # not weak-referenceable: just check
        known = {}
    at = (max_rows, max_bytes)
    if at not in known:
        size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()
        known[at] = size["n"] <= max_rows and size["b"] <= max_bytes
    return known[at]


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it provably has at most ``max_rows`` rows of
    a bounded size in bytes; beyond the bound the plain DataFrame is returned and the planner / AQE
    pick a shuffle join."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df


def broadcast_materialized(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """For a derived lookup table (e.g. one row per distinct key of a huge
    table): write it once to the shared checkpoint folder, then broadcast it
    when it proved small. The expensive derivation runs once, the bound is
    checked on the written rows, and the big side of the later join is
    never shuffled for a small lookup."""
    from ..session import cut_lineage
    done = cut_lineage(df)
    return F.broadcast(done) if is_bounded(done, max_rows) else done


def distinct_rows(df: DataFrame) -> DataFrame:
    """A1: full-row distinct (partial aggregation before the shuffle)."""
    return df.dropDuplicates()


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               values: Sequence[str] | None = None) -> DataFrame:
    """A2: keep, per key, the row with the smallest ``order`` (input
    priority, file row...). Deterministic when ``order`` is unique per key."""
    keys = list(keys)
    values = [c for c in df.columns if c not in keys and c not in order] \
        if values is None else list(values)
    ordk = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys)
              .agg(F.min_by(F.struct(*[F.col(c) for c in values]), ordk).alias("_v"))
              .select(*keys, "_v.*"))


def drop_ambiguous(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A3: drop *every* row whose key occurs more than once (nulls equal).

    An aggregate, not a window: a key with millions of rows is combined
    map-side and then dropped, never gathered into one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    aggs = [F.count(F.lit(1)).alias("_n")]
    if rest:
        aggs.append(F.any_value(F.struct(*[F.col(c) for c in rest])).alias("_v"))
    out = df.groupBy(*keys).agg(*aggs).filter(F.col("_n") == 1)
    return out.select(*keys, "_v.*") if rest else out.select(*keys)
