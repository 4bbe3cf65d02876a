"""Order-dependent scans that stay parallel when one key is huge.

A ``Window.partitionBy(key)`` sends every row of a key to one task. When a
single key (an entity, a group) can hold a third of the table, that task
holds a third of the data. The operators here cut every key's order into
*order buckets* first: a window runs per ``(key, bucket)``, an aggregate with
map-side combine summarises each bucket (its first known value, its row
count), and a window over the small bucket table carries the summary from
bucket to bucket. Everything is a JVM operator, so values keep their type
(64-bit integers, decimals, NaN), and there is one path for every key size.

A bucket is the number of bounds below a row's place in the order, so it is monotone in the order whatever the
bounds are: bounds decide the balance of the tasks, never the result. For one numeric or date column they are
approximate quantiles, compared in the column's own type. For anything else (strings, several columns) they are
every n-th of a sorted sample of places, structs of all order columns that compare from left to right, so that a
value that very many rows share in the first column is cut by the next ones. Rows are sampled by a hash of
their place, at a rate that the row count sets, and bounds keep ``BOUND_CHARS`` characters of a text, so
the sample has a bounded size. All of it is lazy scalar subqueries. Rows that are equal in all order columns share a
bucket. The number of buckets is ``regpanel.scan.partitions`` (the shuffle width where that is unset).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MEASURED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _num_buckets(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    return max(16, int(conf.get("regpanel.scan.partitions", None)
                       or conf.get("spark.sql.shuffle.partitions")))


#: Sampled places per bound, and the characters that a bound keeps of a text.
SAMPLE_PER_BOUND, BOUND_CHARS = 32, 64


def _quantile_bounds(df: DataFrame, column: str, n: int) -> tuple[Column, Column]:
    """The column, and its n - 1 approximate quantiles as a column over all of ``df``."""
    value = F.col(column)
    measured = F.when(~F.isnan(value), value) if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)) else value
    return value, df.agg(F.percentile_approx(measured, [i / n for i in range(1, n)], 10_000).alias("b"))


def _sampled_bounds(df: DataFrame, columns: Sequence[str], n: int) -> tuple[Column, Column]:
    """The place of a row (a struct of its order columns), and n - 1 or fewer places that cut a sample evenly."""
    def bound(c: str) -> Column:
        return (F.substring(F.col(c), 1, BOUND_CHARS) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)).alias(c)

    unit = 1 << 30
    rows = df.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("rows")).scalar()
    drawn = F.pmod(F.xxhash64(*columns), F.lit(unit)) < F.lit(float(unit * SAMPLE_PER_BOUND * n)) / rows
    # The generator keeps the filter above the projection that makes the columns: from a filter pushed under it that
    # holds k of its expressions, Spark derives 2^k constraints as soon as a join or filter lies above.
    places = df.select(F.inline(F.array(F.struct(*columns))))
    # Equal places are drawn together, and count once: the set is bounded even if all rows are equal.
    sample = places.where(drawn).agg(F.sort_array(F.collect_set(F.struct(*[bound(c) for c in columns]))).alias("s"))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get(F.col("s"), F.floor(i * F.size("s") / n).cast("int")))
    return F.struct(*[F.col(c) for c in columns]), sample.select(F.filter(cuts, lambda x: x.isNotNull()).alias("b"))


def order_bucket(df: DataFrame, columns: str | Sequence[str], buckets: int | None = None) -> Column:
    """Monotone bucket of a row's place in the order of ``columns``: equal places share one, nulls come first,
    NaN last. Bounds are looked up in two steps (every n-th, then those between)."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    step = max(2, math.isqrt((buckets or _num_buckets(df)) - 1) + 1)
    n = step * step
    plain = len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, _MEASURED)
    value, found = _quantile_bounds(df, columns[0], n) if plain else _sampled_bounds(df, columns, n)
    every = F.transform(F.sequence(F.lit(1), F.lit(step - 1)), lambda i: F.get(F.col("b"), i * step - 1))
    bounds = found.select(F.struct(F.filter(every, lambda x: x.isNotNull()).alias("coarse"), F.col("b").alias("fine")).alias("s")).scalar()

    def below(some: Column) -> Column:
        # Bounds under the value: its place among them, less one.
        return F.array_position(F.sort_array(F.array_append(some, value)), value) - 1

    coarse = below(bounds["coarse"]).cast("int")
    at = coarse * step + below(F.slice(bounds["fine"], coarse * step + 1, F.lit(step - 1))).cast("int")
    return F.coalesce(at, F.lit(0))


def _key(columns: Sequence[str]) -> Column:
    """Key columns as one column that is never null, so null parts meet in joins."""
    return F.struct(*columns) if columns else F.struct(F.lit(0).alias("all"))


# ------------------------------------------------------------------ W1
def hot_keys(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Keys (``_k``) with more than one in ``buckets`` of the rows: fewer than ``buckets`` by definition."""
    counts = df.groupBy(_key(keys).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    rows = df.agg(F.count(F.lit(1))).scalar()
    return counts.where(F.col("_n") * buckets > rows).select("_k", F.lit(True).alias("_hot"))


def bucketed_next_known(df: DataFrame, keys: list[str], order: list[str], value_col: str,
                        out_col: str, buckets: int | None = None) -> DataFrame:
    """Next-known-value fill (see ``intervals.next_known_fill``).

    A key with no more rows than a task's share is one bucket. Only hot keys are cut, and only their rows are read for the bounds and for
    what the later buckets carry back. The carried values enter the window as rows of their own that come first in their bucket,
    so the rows are shuffled once and joined with nothing but the table of hot keys.
    """
    n = buckets or _num_buckets(df)
    hot = F.broadcast(hot_keys(df, keys, n))
    keyed = df.withColumn("_k", _key(keys))
    known = keyed.join(hot.select("_k"), "_k", "left_semi")
    bucket = order_bucket(known, order, buckets)
    first = known.withColumn("_b", bucket).groupBy("_k", "_b").agg(
        F.min_by(value_col, F.when(F.col(value_col).isNotNull(), F.struct(*order))).alias("_first"))
    later = Window.partitionBy("_k").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    carry = first.select("_k", "_b", F.last("_first", ignorenulls=True).over(later).alias("_value")).where(F.col("_value").isNotNull())
    rows = keyed.join(hot, "_k", "left").withColumn("_b", F.when(F.col("_hot"), bucket).otherwise(F.lit(0))).drop("_hot")
    rows = rows.withColumns({"_value": F.col(value_col), "_carried": F.lit(False)})
    both = rows.unionByName(carry.withColumn("_carried", F.lit(True)), allowMissingColumns=True)
    here = (Window.partitionBy("_k", "_b").orderBy(F.desc("_carried"), *[F.col(c).desc() for c in order])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = both.withColumn("_value", F.last("_value", ignorenulls=True).over(here)).where(~F.col("_carried"))
    return filled.withColumn(out_col, F.col("_value")).select(*dict.fromkeys([*df.columns, out_col]))


# ------------------------------------------------------------------ ranks
def value_ranks(df: DataFrame, groups: Sequence[str], value_col: str,
                buckets: int | None = None, weight: str | None = None) -> DataFrame:
    """Distinct values per group with their multiplicity and position.

    Returns ``groups..., value_col, _cnt, _before, _total`` where ``_before`` is
    the number of rows of the group with a smaller value and ``_total`` the rows
    of the group. Nulls are excluded. ``weight``: a column with the number of
    rows that a row stands for. Average (tie-aware) rank = ``_before + (_cnt + 1) / 2``.
    """
    groups = list(groups)
    present = df.filter(F.col(value_col).isNotNull())
    counts = present.groupBy(*groups, value_col).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).cast("long").alias("_cnt"))
    counts = counts.withColumn("_g", _key(groups)).withColumn("_b", order_bucket(df, value_col, buckets))
    sums = counts.groupBy("_g", "_b").agg(F.sum("_cnt").alias("_s"))
    whole = Window.partitionBy("_g")
    earlier = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_g", "_b", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_off"),
                          F.sum("_s").over(whole).alias("_total"))
    here = Window.partitionBy("_g", "_b").orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("_own", F.coalesce(F.sum("_cnt").over(here), F.lit(0))).join(offsets, ["_g", "_b"])
    return ranked.select(*groups, value_col, "_cnt", (F.col("_own") + F.col("_off")).cast("long").alias("_before"),
                         F.col("_total").cast("long").alias("_total"))


def _mean_rank() -> Column:
    return F.col("_before") + (F.col("_cnt") + 1) / 2.0


def _attach(df: DataFrame, groups: list[str], ranks: DataFrame, value_col: str, column: Column, out_col: str) -> DataFrame:
    """Joins a column of ``value_ranks`` back on group and value (nulls stay null)."""
    found = ranks.select(F.struct(_key(groups), F.col(value_col)).alias("_at"), column.alias(out_col))
    return df.withColumn("_at", F.struct(_key(groups), F.col(value_col))).join(found, "_at", "left").drop("_at")


def average_rank(df: DataFrame, groups: Sequence[str], value_col: str,
                 out_col: str) -> DataFrame:
    """Attach the tie-averaged rank of ``value_col`` within ``groups``."""
    return _attach(df, list(groups), value_ranks(df, groups, value_col), value_col, _mean_rank(), out_col)


def average_ranks(df: DataFrame, groups: Sequence[str],
                  columns: dict[str, str] | Sequence[tuple[str, str]]) -> DataFrame:
    """Tie-averaged ranks of several columns within ``groups``, each ranked in
    its own type. ``columns``: value column -> output rank column (a mapping, or
    pairs when one column is ranked under two names)."""
    out = df
    for name, rank in (columns.items() if isinstance(columns, dict) else columns):
        out = _attach(out, list(groups), value_ranks(df, groups, name), name, _mean_rank(), rank)
    return out


def rank_correlation(df: DataFrame, groups: Sequence[str], x: str, y: str, out: str) -> DataFrame:
    """Pearson correlation of the tie-averaged ranks of ``x`` and ``y`` per group, and ``n``.

    Equal pairs are counted first; ranks and moments are weighted by the counts. Ranks are
    centred on their mean, which is ``(n + 1) / 2`` whatever the ties, before they are squared.
    """
    groups = list(groups)
    pairs = df.select(*groups, F.col(x).alias("_x"), F.col(y).alias("_y"))
    pairs = pairs.groupBy(*groups, "_x", "_y").agg(F.count(F.lit(1)).alias("_c"))
    centred = _mean_rank() - (F.col("_total") + 1) / 2.0
    ranked = pairs
    for value, rank in (("_x", "_rx"), ("_y", "_ry")):
        ranked = _attach(ranked, groups, value_ranks(pairs, groups, value, weight="_c"), value, centred, rank)

    def moment(a: str, b: str) -> Column:
        return F.sum(F.col("_c") * F.col(a) * F.col(b))

    # A group whose ranks do not vary gets null (ANSI mode would raise on a division by zero).
    r = F.try_divide(moment("_rx", "_ry"), F.sqrt(moment("_rx", "_rx")) * F.sqrt(moment("_ry", "_ry")))
    return ranked.groupBy(*groups).agg(r.alias(out), F.sum("_c").cast("long").alias("n"))


def exact_quantiles(df: DataFrame, groups: Sequence[str], value_col: str,
                    probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas ``quantile`` / SQL
    ``percentile_cont``) without gathering a group into one task.

    Returns ``groups..., p, value``. Every ranked value knows its group's size, so the
    wanted positions are compared in place; only values at one of them survive.
    """
    groups = list(groups)
    ranks = value_ranks(df, groups, value_col)
    last = F.col("_total") - 1
    wanted = ranks.withColumn("_t", F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("p"), F.floor(last * F.lit(float(p))).cast("long").alias("k0"),
                 (last * F.lit(float(p)) - F.floor(last * F.lit(float(p)))).alias("frac"),
                 F.least(F.floor(last * F.lit(float(p))) + 1, last).cast("long").alias("k1"))
        for p in probs]))).select(*groups, value_col, "_cnt", "_before", "_t.*")
    hit = wanted.where((F.col("_before") <= F.col("k1")) & (F.col("_before") + F.col("_cnt") > F.col("k0")))
    ends = hit.groupBy(*groups, "p", "frac").agg(
        F.max(F.when(F.col("_before") <= F.col("k0"), F.col(value_col))).alias("_x0"),
        F.max(F.when(F.col("_before") <= F.col("k1"), F.col(value_col))).alias("_x1"))
    return ends.select(*groups, "p", (F.col("_x0") + F.col("frac") * (F.col("_x1") - F.col("_x0"))).alias("value"))
