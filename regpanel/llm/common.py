"""Helpers shared by the corpus operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_path

#: Columns of the ``documents`` table; the filtering stages of the pipeline return them.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(key: str, folds: int, fold: int) -> Column:
    """Whether ``crc32(key as text) mod folds = fold``; a null key is in no fold."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(False))


#: Bytes of text that the driver takes per class of a labelled sample, at the most (but one text at least).
SAMPLE_BYTES = 64 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, folds: int, held_fold: int,
                    per_class: int, key: str = "doc_id", text: str = "text", most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, int]]:
    """A bounded sample of labelled texts for the driver to fit a classifier on.

    Of each class the ``per_class`` keys of least hash are taken (all, if there are fewer), and their texts in
    that order while they fit ``most_bytes``, so the sample does not depend on partitioning. Rows held out
    never enter. A key labelled twice counts as 1 if any of its labels is 1; a key on rows of several texts stands
    for one of them (of least hash), which Spark picks before anything reaches the driver.
    """
    marked = (labels.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y"))
              .where("_k is not null and _y in (0, 1)").groupBy("_k").agg(F.max("_y").alias("_y"))
              .where(~fold_of("_k", folds, held_fold)))
    place = F.xxhash64(F.col("_k"), F.lit(17))
    least = [marked.where(F.col("_y") == y).orderBy(place, "_k").limit(per_class) for y in (0, 1)]
    # No more keys than two classes have places, so the texts are not shuffled to find them.
    chosen = F.broadcast(least[0].unionByName(least[1]))
    found = docs.select(F.col(key).alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("_t")).join(chosen, "_k")
    one = found.groupBy("_k", "_y").agg(F.min_by("_t", F.struct(F.xxhash64("_t"), F.col("_t"))).alias("_t"))
    before = Window.partitionBy("_y").orderBy(place, "_k").rowsBetween(Window.unboundedPreceding, -1)
    fits = F.coalesce(F.sum(F.octet_length("_t")).over(before), F.lit(0)) + F.octet_length("_t") <= most_bytes
    rows = one.withColumn("_fits", fits | (F.row_number().over(Window.partitionBy("_y").orderBy(place, "_k")) == 1)).where("_fits").select("_t", "_y").toArrow()
    # A fixed order, and a repeated text counts once.
    return sorted(set(zip(rows.column("_t").to_pylist(), rows.column("_y").to_pylist())))


def salt_count(spark: SparkSession) -> int:
    """How many parts a hot group is split into: the width of a shuffle, 16 at least."""
    return max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read again.

    Cuts the lineage (a lost executor recomputes nothing before this point),
    keeps column pruning for later reads, and gives the planner real sizes.
    """
    import uuid

    spark = df.sparkSession
    path = checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def pass_columns(df: DataFrame, wanted: Sequence[str], reserved: Sequence[str]) -> list[str]:
    """Columns of ``df`` to carry along: all but ``wanted`` and names the operator adds."""
    taken = {c.lower() for c in (*wanted, *reserved)}
    return [c for c in df.columns if c.lower() not in taken]


#: A key that more than one in so many rows have is hot; there are no more hot keys than that.
HOT_SHARE = 10_000


def joined_to_keys(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """``rows`` joined to ``side``, a written table of one small row per key whose ``_rows`` counts the rows that have the key.

    Hot keys, fewer than ``HOT_SHARE`` whatever the table, are broadcast, so that their rows stay where they
    are; the others are joined by the key, none of which has more rows than that share.
    """
    total = side.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    hot, plain = F.col("_rows") * HOT_SHARE > total, side.drop("_rows")
    few = F.broadcast(side.where(hot).select(*plain.columns))
    many = side.where(~hot).select(*plain.columns)
    return rows.join(few, key).unionByName(rows.join(few.select(key), key, "left_anti").join(many, key))
