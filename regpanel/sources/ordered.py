"""Row order of text files that are read in splits.

A text format has no row index, and ids that follow the partitions of a scan depend on how
its splits were packed: files are dealt to partitions by size, not by name, and the ids jump where a partition
ends. Here a row is placed by its file, the byte at which its split of the file starts, and its sequence
within that split, which are the same however splits are packed. Rows are then numbered without a sort: the rows of
every split are counted, a running sum over the small table of splits says how many stand
before it, and a row adds its distance from the first row of its split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_SPLIT = ["_source", "_file", "_split"]


def located(raw: DataFrame, source: int = 0) -> DataFrame:
    """A plain file scan with the place of every row: ``_source`` (the caller's order of the
    paths), ``_file``, ``_split``, ``_seq``. Nothing may be filtered before."""
    return raw.select("*", F.lit(source).alias("_source"), F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_seq"))


def numbered(rows: DataFrame, out: str, in_file: str | None = None) -> DataFrame:
    """Located rows with ``out``, their number from 0 in the order of sources, files (by path)
    and rows, and ``in_file``, their number within the file; the place columns but ``_file`` drop.

    The rows are written to the shared folder first: their sequence is read twice, and must be the same.
    """
    rows = cut_lineage(rows)
    splits = rows.groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    # One row per split: its number is the input's size over the split size.
    order = Window.orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*_SPLIT[:2]).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select(*_SPLIT, "_first", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_all"),
                           F.coalesce(F.sum("_n").over(within), F.lit(0)).alias("_own"))
    at = F.col("_seq") - F.col("_first")
    found = rows.join(before, _SPLIT).withColumn(out, F.col("_all") + at)
    if in_file:
        found = found.withColumn(in_file, F.col("_own") + at)
    return found.drop("_source", "_split", "_seq", "_first", "_all", "_own")


def numbered_scans(scans: Sequence[DataFrame], out: str) -> DataFrame:
    """Plain scans of one schema, one after the other, numbered from 0 in that order."""
    rows = located(scans[0], 0)
    for i, scan in enumerate(scans[1:], 1):
        rows = rows.unionByName(located(scan, i))
    return numbered(rows, out).drop("_file")
