"""CSV snapshot scan and sinks."""

from __future__ import annotations

import fnmatch
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fs import child_names, path_exists, touch
from .ordered import located, numbered

NULL_TOKEN = "NA"


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType,
                   glob: str = "data-*.csv", null_value: str | None = NULL_TOKEN,
                   **options) -> DataFrame | None:
    """A directory -> its ``data-*.csv`` files; a single ``.csv`` file is
    accepted; anything else (or nothing found) -> ``None`` so the stage can
    be skipped. Header line, ``"`` escape, explicit schema (no inference).

    ``null_value`` is read symmetrically with ``write_csv`` (the reference
    wrote ``NA`` but never read it back as null).
    """
    opts = {"header": "true", "escape": '"'}
    if null_value is not None:
        opts["nullValue"] = null_value
    opts.update({k: str(v) for k, v in options.items()})
    reader = spark.read.schema(schema).options(**opts)
    if path.endswith(".csv"):
        return reader.csv(path) if path_exists(spark, path) else None
    # A folder without matching files means "nothing to read" (None).
    if not any(fnmatch.fnmatch(n, glob) for n in child_names(spark, path)):
        return None
    return reader.option("pathGlobFilter", glob).csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", single_file: bool = False,
              mode: str = "overwrite", null_value: str = NULL_TOKEN) -> None:
    """CSV sink with header, ``NA`` for null, ``"`` escape. Output is a
    directory written in parallel; ``single_file=True`` (one task writes
    everything) only when a consumer insists on one file."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode)
        .options(header="true", nullValue=null_value, escape='"', sep=sep)
        .csv(path))


#: Folder of the markers that name the batches appended to a table; readers of files skip it.
_COMMITS = "_commits"


def append_csv(df: DataFrame, path: str, columns: list[str], sep: str = ",", batch_id: str | None = None) -> bool:
    """Append a fixed projection of one batch to a CSV table, once (a batch without an id is a new one).

    A batch is written to a folder of its own, replacing what a failed attempt may have left
    there, and counts when its marker exists, which is made last. A batch whose marker is there is not
    written again. Returns whether this call wrote it. Every file has its own header.
    """
    batch_id = batch_id or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch_id):
        raise ValueError(f"a batch id names a folder: letters, digits, '.', '_' and '-' only, not {batch_id!r}")
    spark = df.sparkSession
    marker = f"{path}/{_COMMITS}/{batch_id}"
    if path_exists(spark, marker):
        return False
    write_csv(df.select(*columns), f"{path}/batch={batch_id}", sep=sep)
    touch(spark, marker)
    return True


def appended_batches(spark: SparkSession, path: str) -> list[str]:
    """Ids of the batches that were appended whole."""
    return sorted(child_names(spark, f"{path}/{_COMMITS}"))


def read_appended(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                  null_value: str = NULL_TOKEN) -> DataFrame:
    """The rows of all appended batches and their ``batch``; what a failed attempt left is not read."""
    reader = spark.read.schema(schema).options(header="true", escape='"', sep=sep, nullValue=null_value)
    batches = appended_batches(spark, path)
    if not batches:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch", T.StringType())]))
    rows = reader.csv([f"{path}/batch={b}" for b in batches])
    return rows.withColumn("batch", F.regexp_extract("_metadata.file_path", "/batch=([^/]+)/[^/]*$", 1))


def whole_number_text(value: Column) -> Column:
    """A double as C's ``%.0f`` prints it: halves to even, all digits, ``-0``, ``inf``.

    Null and NaN give null (both are missing in an export). Java's formatter rounds halves up and prints
    zeros after 17 digits, so the digits come from whole numbers: one up to 2^63, two beyond (multiples of 2^63
    and the rest, both exact); Java's text is left from 2^126 on.
    """
    a = F.rint(F.abs(value))
    limb = F.lit(2.0 ** 63)
    high = F.floor(a / limb)
    low = (a - high * limb).cast("long").cast("decimal(19,0)")
    two = high.cast("decimal(18,0)") * F.lit(str(2 ** 63)).cast("decimal(19,0)") + low
    text = (F.when(value.isNull() | F.isnan(value), F.lit(None)).when(a == float("inf"), F.lit("inf")).when(a < limb, a.cast("long").cast("string"))
             .when(a < 2.0 ** 122, two.cast("string")).otherwise(F.format_string("%.0f", a)))
    # Comparisons take -0.0 for 0.0; its text does not.
    return F.when(value.cast("string").startswith("-"), F.concat(F.lit("-"), text)).otherwise(text)


def format_whole_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Render float columns as ``%.0f`` text for an export."""
    return df.withColumns({c: whole_number_text(F.col(c).cast("double")) for c in columns})


def read_statistics_table(spark: SparkSession, path: str | list[str], id_columns: list[str],
                          value_columns: list[str], drop_first_column: bool = True,
                          label_rows: int = 1, **options) -> DataFrame:
    """Published statistics CSVs with a preamble, a header and ``label_rows`` lines of units or labels
    before the data; every file has its own preamble, and may be read in any number of splits.

    Columns are named by position (optionally skipping the first). The header is the first line of a file
    that repeats the value labels; what stands above it, it, and the label rows below it are not
    data. Every other line is, whether or not it has any value; only wholly blank lines drop. A file with lines but without a
    header raises. Text is trimmed and values become doubles. ``_row`` numbers the lines of all files, for
    first-wins rules downstream.
    """
    n = len(id_columns) + len(value_columns) + (1 if drop_first_column else 0)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n)])
    raw = spark.read.schema(schema).options(header="false", escape='"').options(**{k: str(v) for k, v in options.items()}).csv(path)
    names = list(id_columns) + list(value_columns)
    cols = [f"_c{i}" for i in range(n)][1 if drop_first_column else 0:]
    rows = numbered(located(raw), "_row", "_line").select(*[F.trim(F.col(c)).alias(nm) for c, nm in zip(cols, names)], "_file", "_row", "_line")
    is_header = F.lit(True)
    for v in value_columns:
        is_header = is_header & F.coalesce(F.col(v) == F.lit(v), F.lit(False))
    # One row per file: as small as the list of files, and left to the planner.
    headers = rows.groupBy("_file").agg(F.min(F.when(is_header, F.col("_line"))).alias("_header"))
    headers = headers.select("_file", F.when(F.col("_header").isNotNull(), F.col("_header")).otherwise(
        F.raise_error(F.concat(F.lit("no header line in "), F.col("_file")))).alias("_header"))
    some = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in names]).isNotNull()
    return (rows.join(headers, "_file").filter((F.col("_line") > F.col("_header") + label_rows) & some)
                .withColumns({v: F.col(v).try_cast("double") for v in value_columns})
                .select(*names, "_row"))
