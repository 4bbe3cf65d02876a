"""W2, streaming form: validity intervals maintained while snapshots arrive.

Snapshots land as files; a streaming ``groupBy(state keys)`` keeps, per
state, the first and last snapshot date and the first row's carried
columns (``min`` / ``max`` / ``min_by`` are all mergeable, so the state is
one row per entity state). In update mode each micro-batch carries only the
states that changed; ``foreachBatch`` writes them to a folder of their epoch
(``<out>/v=<epoch>``), so what a batch writes follows the batch, and a
replayed batch overwrites its own folder. Readers take every key's row of the
newest epoch (``latest_intervals``); ``compact_intervals`` writes that down
once in a while. (A table format with MERGE would do this in place.)

No watermark: a registry snapshot may restate any entity at any time, so
state is kept for every entity state, in the state store of the
checkpoint (use the RocksDB provider for large registries).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_path
from ..sources.fs import child_names, path_exists


def _complete(spark: SparkSession, out_path: str, kind: str) -> list[int]:
    """Epochs of the complete ``kind=<epoch>`` folders, ascending."""
    found = [n for n in child_names(spark, out_path) if n.startswith(f"{kind}=")]
    return sorted(int(n.split("=")[1]) for n in found if path_exists(spark, f"{out_path}/{n}/_SUCCESS"))


def latest_intervals(spark: SparkSession, out_path: str, keys: Sequence[str]) -> DataFrame | None:
    """The interval table: every key's row of the newest epoch that changed it (None
    if there is none). Reads the last compacted table and the epochs after it."""
    bases = _complete(spark, out_path, "base")
    since = bases[-1] if bases else -1
    parts = [("base", since)] if bases else []
    parts += [("v", e) for e in _complete(spark, out_path, "v") if e > since]
    if not parts:
        return None
    every = [spark.read.parquet(f"{out_path}/{kind}={e}").withColumn("_epoch", F.lit(e)) for kind, e in parts]
    rows = reduce(DataFrame.unionByName, every)
    columns = [c for c in rows.columns if c not in (*keys, "_epoch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), "_epoch").alias("_row"))
    return newest.select(*keys, "_row.*")


def compact_intervals(spark: SparkSession, out_path: str, keys: Sequence[str]) -> None:
    """Writes the interval table as one folder, so that reads need not fold older
    epochs. Run it between batches; older folders may be removed afterwards."""
    epochs = _complete(spark, out_path, "v")
    table = latest_intervals(spark, out_path, keys)
    if table is not None and epochs and epochs[-1] not in _complete(spark, out_path, "base"):
        table.write.mode("overwrite").parquet(f"{out_path}/base={epochs[-1]}")


def stream_state_hull(spark: SparkSession, in_dir: str, schema: T.StructType,
                      keys: Sequence[str], date_col: str, out_path: str,
                      carry: Sequence[str] = (), order: Sequence[str] = (),
                      name: str = "hull", checkpoint_location: str | None = None,
                      glob: str = "*.parquet", file_format: str = "parquet",
                      available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``order`` breaks ties of the first row's carried
    columns. Output columns: keys, carried columns, start_date, end_date."""
    keys, carry, order = list(keys), list(carry), list(order)
    ckpt = checkpoint_location or checkpoint_path(spark, f"stream-{name}")
    snaps = (spark.readStream.format(file_format).schema(schema)
             .option("pathGlobFilter", glob).load(in_dir))
    aggs = [F.min(date_col).alias("start_date"), F.max(date_col).alias("end_date")]
    if carry:
        aggs.append(F.min_by(F.struct(*[F.col(c) for c in carry]),
                             F.struct(F.col(date_col), *[F.col(c) for c in order])).alias("_first"))
    hull = snaps.groupBy(*keys).agg(*aggs)
    cols = keys + [f"_first.{c}" for c in carry] + ["start_date", "end_date"] if carry else \
        keys + ["start_date", "end_date"]
    hull = hull.select(*cols)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        # Changed keys only (update mode): what is written follows the batch, not the
        # table. A replayed epoch overwrites its own folder.
        changed = batch.select(*keys, *carry, "start_date", "end_date")
        changed.write.mode("overwrite").parquet(f"{out_path}/v={epoch_id}")

    writer = (hull.writeStream.outputMode("update").foreachBatch(upsert)
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()
