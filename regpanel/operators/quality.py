"""Profiling and validation operators.

Everything is an aggregate with map-side combine, or the bucketed
rank machinery in ``scan`` -- no global window, no ``percentile`` buffer
holding a whole column in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scan import exact_quantiles, rank_correlation


def group_counts(df: DataFrame, keys: Sequence[str], out: str = "count") -> DataFrame:
    """A4: rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def group_sums(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
               drop_null_keys: bool = True) -> DataFrame:
    """A5: sum of several measures per group; a group without any value sums to
    0. Groups with a null key part are dropped by default (pandas ``groupby``
    semantics)."""
    if drop_null_keys:
        df = df.na.drop(subset=list(keys))
    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A10: nulls per column in one pass, as ``column, null_count, row_count``."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_n{i}")
                    for i, c in enumerate(columns)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("null_count"),
                 F.col("_rows").alias("row_count"))
        for i, c in enumerate(columns)])).alias("_p")).select("_p.*")


DESCRIBE_PROBS = (0.25, 0.5, 0.75)


def describe(df: DataFrame, column: str, groups: Sequence[str] = ()) -> DataFrame:
    """Pandas ``describe`` statistics in long form -- ``groups...,
    statistic, value`` with count, mean, std (sample), min, 25%, 50%, 75%
    (exact, linear interpolation) and max; per group when given."""
    groups = list(groups)
    base = (df.filter(F.col(column).isNotNull())
              .groupBy(*groups)
              .agg(F.count(F.lit(1)).cast("double").alias("count"),
                   F.avg(column).alias("mean"),
                   F.stddev_samp(column).alias("std"),
                   F.min(column).cast("double").alias("min"),
                   F.max(column).cast("double").alias("max")))
    base = base.unpivot(groups, ["count", "mean", "std", "min", "max"], "statistic", "value")
    q = exact_quantiles(df, groups, column, DESCRIBE_PROBS)
    label = F.concat((F.col("p") * 100).cast("int").cast("string"), F.lit("%"))
    q = q.select(*groups, label.alias("statistic"), F.col("value").cast("double"))
    return base.unionByName(q)


def spearman(df: DataFrame, x: str, y: str, groups: Sequence[str] = (),
             out: str = "spearman") -> DataFrame:
    """Spearman rank correlation (average ranks for ties) of ``x`` and
    ``y``, over rows where both are present; per group when given.

    Values are ranked in their own type (``scan.rank_correlation``: no cast, no
    global window). A group whose ranks do not vary gets null (pandas gives NaN).
    """
    groups = list(groups)
    def present(c):  # pandas treats NaN as missing too
        ok = F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            ok = ok & ~F.isnan(F.col(c))
        return ok

    pairs = df.select(*groups, *dict.fromkeys([x, y])).filter(present(x) & present(y))
    return rank_correlation(pairs, groups, x, y, out)
