"""Validate registry counts against published statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..assets.fixed import (CORRELATION_EXCLUDED_GROUPS, EXCLUDED_REGIONS, REGION_TYPE_WORDS,
                            STATISTICS_EXCLUDED, STATISTICS_REGION_FIXES)
from ..operators.dedupe import distinct_rows, first_wins
from ..operators.keys import exclude_substrings, normalized_difference, override_values
from ..operators.quality import describe, group_counts, group_sums, spearman
from ..operators.regions import apply_region_mapping, region_mapping
from ..operators.reshape import to_long
from ..session import cut_lineage


class LazyFrames(Mapping):
    """Named DataFrames, each built when it is first asked for: a plan costs time to analyse even
    if nobody runs it. A builder gets the mapping, for frames made from others."""

    def __init__(self, builders: dict[str, Callable[[LazyFrames], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def registry_counts(snapshots: DataFrame, region: str = "region_name", tin: str = "tin",
                    date: str = "data_date", activity: str = "activity_code_main",
                    year: str = "year") -> DataFrame:
    """A1 + A4: distinct entities per (region, year, activity)."""
    d = distinct_rows(snapshots.select(F.col(region).alias("region"), F.col(tin).alias("tin"),
                                       F.year(date).alias(year), F.col(activity).alias("activity")))
    return group_counts(d, ["region", year, "activity"], "count")


def counts_by_group(counts: DataFrame, classifier: DataFrame, code_col: str = "code",
                    group_col: str = "group", year: str = "year",
                    count_col: str = "count") -> DataFrame:
    """J10 + A5: attach the activity group (rows without one drop out, as
    a pandas merge + groupby does) and re-sum per (region, year, group)."""
    cls = classifier.select(F.col(code_col).alias("activity"), F.col(group_col).alias("group"))
    j = counts.join(cls, "activity", "inner")
    return group_sums(j, ["region", year, "group"], [count_col])


def compare(registry: DataFrame, statistics: DataFrame,
            keys: Sequence[str] = ("region", "year", "group"),
            a: str = "count_reestr", b: str = "count_stat") -> DataFrame:
    """J10 + P18: keep keys present in both; ``norm_diff = (a-b)/(a+b)``."""
    m = registry.join(statistics, list(keys), "left").na.drop(subset=[b])
    return m.withColumn("norm_diff", normalized_difference(a, b))


def long_form(stats: DataFrame, keys: Sequence[str] = ("region", "year", "group"),
              values: Sequence[str] = ("count_reestr", "count_stat")) -> DataFrame:
    """R2: one row per (keys, source) with the count."""
    return to_long(stats.select(*keys, *values), list(keys), list(values), "source", "count")


def summary_builders(stats: DataFrame, a: str, b: str,
                     exclude_groups: Sequence[str]) -> dict[str, Callable[[LazyFrames], DataFrame]]:
    """One builder per summary of C8. Correlations that are described as well are written once."""
    s = stats.filter(~F.col("group").isin(list(exclude_groups))) if exclude_groups else stats
    return {
        "overall": lambda _: spearman(stats, a, b),
        "by_year_region": lambda _: cut_lineage(spearman(s, a, b, ["year", "region"])),
        "by_year_region_description": lambda all_: describe(all_["by_year_region"], "spearman"),
        "by_year_group": lambda _: spearman(s, a, b, ["year", "group"]),
        "by_group": lambda _: spearman(stats, a, b, ["group"]),
        "by_region_group": lambda _: cut_lineage(spearman(stats, a, b, ["region", "group"])),
        "by_region_group_description": lambda all_: describe(all_["by_region_group"], "spearman"),
        "norm_diff": lambda _: describe(stats, "norm_diff"),
    }


def summaries(stats: DataFrame, a: str = "count_reestr", b: str = "count_stat",
              exclude_groups: Sequence[str] = ()) -> LazyFrames:
    """A12 + A11: rank correlation overall and per (year, region),
    (year, group), group and (region, group); descriptions of norm_diff and of
    the correlations per (year, region) and (region, group). Each is built when asked for."""
    return LazyFrames(summary_builders(stats, a, b, exclude_groups))


def prepare_statistics(stats: DataFrame, classifier: DataFrame, regions: DataFrame,
                       year_columns: Sequence[str], manual_fixes: dict[str, str] | None = None,
                       exclude: Sequence[str] = (), region_col: str = "region_name",
                       activity_col: str = "activity", order_col: str = "_row") -> DataFrame:
    """``statistics_sums`` with its regions resolved: ``resolved_statistics``."""
    s = statistics_sums(stats, classifier, year_columns, region_col, activity_col, order_col)
    mapping = region_mapping(s.select(region_col), regions, REGION_TYPE_WORDS, 80.0)
    return resolved_statistics(s, mapping, year_columns, manual_fixes, exclude, region_col)


def statistics_sums(stats: DataFrame, classifier: DataFrame, year_columns: Sequence[str], region_col: str = "region_name",
                    activity_col: str = "activity", order_col: str = "_row") -> DataFrame:
    """Published statistics (wide, one column per year) summed per raw region and group, written once.

    Activity labels map to groups through the classifier's group header rows
    (blank code); a duplicated (region, activity) keeps its first row in file
    order (without ``order_col``: the least row); counts are summed per (region,
    group), missing ones as 0.
    """
    headers = (classifier.filter(F.col("code").isNull() | (F.trim(F.col("code")) == ""))
                         .groupBy(F.col("name").alias(activity_col)).agg(F.min("group").alias("group")))
    s = stats.join(headers, activity_col, "inner")
    order = [order_col] if order_col in stats.columns else list(year_columns)
    s = first_wins(s, [region_col, activity_col], order, [*year_columns, "group"])
    s = s.groupBy(region_col, "group").agg(*[F.coalesce(F.sum(y), F.lit(0.0)).alias(y) for y in year_columns])
    return cut_lineage(s)


def resolved_statistics(sums: DataFrame, mapping: DataFrame, year_columns: Sequence[str], manual_fixes: dict[str, str] | None = None,
                        exclude: Sequence[str] = (), region_col: str = "region_name") -> DataFrame:
    """Sums per raw region -> long ``region, group, year, count_stat``: region names resolve through J7, then the
    manual overrides apply (exact match on the raw name); the excluded raw
    names (trimmed) drop; years melt to rows (R2)."""
    s = apply_region_mapping(sums.withColumn("region", F.col(region_col)), "region", mapping)
    s = override_values(s, region_col, "region", manual_fixes or {})
    excluded = [e.strip() for e in exclude]
    if excluded:
        s = s.filter(~F.trim(F.col(region_col)).isin(excluded))
    long = to_long(s.select("region", "group", *year_columns), ["region", "group"],
                   list(year_columns), "year", "count_stat")
    return long.select("region", "group", F.col("year").cast("int").alias("year"),
                       "count_stat")


def registry_by_region(counts: DataFrame, classifier: DataFrame, regions: DataFrame,
                       count_col: str = "count") -> DataFrame:
    """Registry counts per (raw region, year, activity code) -> per
    (canonical region, year, group): classifier by code, sums, region
    resolution, sums again (rows whose region does not resolve drop)."""
    g = cut_lineage(counts_by_group(counts, classifier, count_col=count_col))
    return resolved_registry(g, region_mapping(g.select("region"), regions, REGION_TYPE_WORDS, 80.0), count_col)


def resolved_registry(by_group: DataFrame, mapping: DataFrame, count_col: str = "count") -> DataFrame:
    """Counts per (raw region, year, group) -> ``count_reestr`` per (canonical region, year, group)."""
    g = apply_region_mapping(by_group, "region", mapping).filter(F.col("region").isNotNull())
    return group_sums(g, ["region", "year", "group"], [count_col]) \
        .withColumnRenamed(count_col, "count_reestr")


def run_validation(snapshots: DataFrame, statistics: DataFrame, classifier: DataFrame,
                   regions: DataFrame, year_columns: Sequence[str],
                   excluded_regions: Sequence[str] = tuple(EXCLUDED_REGIONS)) -> LazyFrames:
    """C8 end to end with the fixed overrides / exclusions: registry
    snapshots (validation projection, S12) and the published statistics
    table (S13) -> the comparison table, its long form and the summaries.

    The table is written to the shared folder once; the long form and every summary read that, and
    are built when asked for.
    """
    snaps = exclude_substrings(snapshots, "region_name", [r.upper() for r in excluded_regions])
    # Legal entities only: the organisation's number, not a person's.
    snaps = snaps.filter(F.col("org_tin").isNotNull()).withColumn("tin", F.lpad(F.col("org_tin").cast("string"), 10, "0"))
    by_group = cut_lineage(counts_by_group(registry_counts(snaps), classifier))
    sums = statistics_sums(statistics, classifier, year_columns)
    # One lookup for the region names of both sides.
    names = by_group.select("region").unionByName(sums.select(F.col("region_name").alias("region")))
    mapping = region_mapping(names, regions, REGION_TYPE_WORDS, 80.0)
    stat = resolved_statistics(sums, mapping, year_columns, STATISTICS_REGION_FIXES, STATISTICS_EXCLUDED)
    table = cut_lineage(compare(resolved_registry(by_group, mapping), stat))
    return LazyFrames({"table": lambda _: table, "long": lambda _: long_form(table),
                       **summary_builders(table, "count_reestr", "count_stat", CORRELATION_EXCLUDED_GROUPS)})
