"""The whole pipeline as Spark jobs with written stage tables.

Each stage writes a Parquet table under ``base`` (shared storage). The
tables cut the lineage -- a lost executor costs one stage, not the whole
run -- and let a stage be re-run alone, like the source tool's stage
commands. Layout::

    base/download/{smb,revexp,empl}/*.zip   input archives
    base/extract/{ds}/_archive=…/_status={ok,quarantine}/   base/extract/{ds}-manifest/
    base/aggregate/{ds}/ base/geocode/     base/panel/ (Parquet)  base/panel-csv/
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.matching import abbreviation_dictionary
from ..sources.archive import record_ingested
from ..sources.csv import write_csv
from ..sources.fs import child_names, path_exists, remove
from .extract import Extracted, extract
from .geocode import geocode
from .panel import panelize
from .registry import aggregate_facts, aggregate_registry

DATASETS = ("smb", "revexp", "empl")


@dataclass
class Dimensions:
    cities: DataFrame
    settlements: DataFrame
    regions: DataFrame
    abbreviations: DataFrame          # raw table: name, name_full, _row
    classifier: DataFrame | None = None


def _p(base: str, *parts: str) -> str:
    return os.path.join(base, *parts)


def _counted(df: DataFrame, name: str, metrics: dict) -> DataFrame:
    """Count rows as a side effect of the write (``observe``), instead
    of a separate ``count()`` job per stage."""
    obs = Observation(name)
    metrics[name] = obs
    return df.observe(obs, F.count(F.lit(1)).alias("rows"))


class _StatusCount:
    """One metric of a shared observation (``report`` reads ``.get``)."""

    def __init__(self, obs: Observation, field: str):
        self._obs, self._field = obs, field

    @property
    def get(self) -> dict[str, int]:
        return {"rows": self._obs.get[self._field]}


def report(metrics: dict) -> dict[str, int]:
    """Row counts of the stages that ran (available after their writes)."""
    return {k: v.get["rows"] for k, v in metrics.items()}


def read_quarantine(spark: SparkSession, base: str, dataset: str) -> DataFrame:
    """Members of ``dataset`` that did not parse (archive, member, text)."""
    from ..sources.xml import CORRUPT
    return (spark.read.parquet(_p(base, "extract", dataset))
                 .filter(F.col("_status") == "quarantine")
                 .select("archive", "member", CORRUPT))


def read_stage(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """A stage table: Parquet (this library's stage format) or, for data
    extracted earlier by other tools, ``data-*.csv`` / a single ``.csv``
    with the dataset's explicit schema and ``dd.MM.yyyy`` dates (S1)."""
    has_parquet = any(
        n.endswith(".parquet") or n.startswith(("_archive=", "_status="))
        or (n.startswith("part-") and ".csv" not in n)
        for n in child_names(spark, path))
    if has_parquet:
        df = spark.read.parquet(path)
        if "_status" in df.columns:   # extraction output: documents only
            df = (df.filter(F.col("_status") == "ok")
                    .drop("_status", "_corrupt_record", "_archive"))
        return df
    from ..sources.csv import read_snapshots
    from ..sources.schemas import INPUT_DATE_FORMAT, SCHEMAS
    schema = SCHEMAS[dataset]
    df = read_snapshots(spark, path, schema, dateFormat=INPUT_DATE_FORMAT, null_value=None)
    if df is None:
        raise FileNotFoundError(f"no Parquet or data-*.csv extract under {path}")
    return df


def write_extract(ex: Extracted, path: str, name: str, metrics: dict) -> None:
    """C1's output: documents and quarantined members of new archives, each in the partition of its
    archive and status.

    One job: every member is inflated and parsed once. What a run that died left of these archives is
    removed first, whatever its statuses (an archive that had broken members then may have none now), and
    dynamic overwrite replaces the partitions, so a replay duplicates nothing. The manifest names an archive
    only after this.
    """
    spark = ex.parsed.sparkSession
    # The names of a run's new archives: one per file of the download folder.
    for row in ex.archives.select("name").toLocalIterator():
        remove(spark, _p(path, f"_archive={row['name']}"))
    obs = Observation(name)
    metrics[name] = _StatusCount(obs, "ok")
    metrics[name.replace("extract", "quarantine", 1)] = _StatusCount(obs, "quarantine")
    (ex.parsed.withColumn("_archive", F.substring_index("archive", "/", -1))
       .observe(obs, F.count_if(F.col("_status") == "ok").alias("ok"),
                F.count_if(F.col("_status") == "quarantine").alias("quarantine"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("_archive", "_status").parquet(path))


def run_extract(spark: SparkSession, base: str, dims: Dimensions,
                codes: Sequence[str] | None = None, metrics: dict | None = None) -> None:
    """C1 for every dataset with archives; new archives only (manifest). A dataset
    whose folder does not exist is skipped; with none at all there is nothing to run on."""
    if not any(path_exists(spark, _p(base, "download", ds)) for ds in DATASETS):
        raise FileNotFoundError(f"no dataset folder under {_p(base, 'download')}")
    for ds in DATASETS:
        src = _p(base, "download", ds)
        if not path_exists(spark, src):
            continue
        manifest = _p(base, "extract", f"{ds}-manifest")
        ex = extract(spark, src, ds, dims.classifier if dims else None, codes,
                     manifest_path=manifest)
        write_extract(ex, _p(base, "extract", ds), f"extract_{ds}", metrics if metrics is not None else {})
        record_ingested(ex.archives, manifest)


def run_aggregate(spark: SparkSession, base: str, metrics: dict | None = None) -> None:
    """C2 -> C3 / C4: registry intervals first (the facts need its keys)."""
    m = metrics if metrics is not None else {}
    smb = read_stage(spark, _p(base, "extract", "smb"), "smb")
    _counted(aggregate_registry(smb), "aggregate_smb", m).write.mode("overwrite") \
        .parquet(_p(base, "aggregate", "smb"))
    registry = spark.read.parquet(_p(base, "aggregate", "smb"))
    for ds, measures in (("revexp", ["revenue", "expenditure"]), ("empl", ["employees_count"])):
        path = _p(base, "extract", ds)
        if not path_exists(spark, path):
            continue
        facts = read_stage(spark, path, ds)
        _counted(aggregate_facts(facts, measures, registry, tiebreak=measures), f"aggregate_{ds}", m) \
            .write.mode("overwrite").parquet(_p(base, "aggregate", ds))


def run_geocode(spark: SparkSession, base: str, dims: Dimensions,
                metrics: dict | None = None) -> None:
    """C5."""
    m = metrics if metrics is not None else {}
    records = spark.read.parquet(_p(base, "aggregate", "smb"))
    out = geocode(records, dims.cities, dims.settlements, dims.regions,
                  abbreviation_dictionary(dims.abbreviations))
    _counted(out, "geocode", m).write.mode("overwrite").parquet(_p(base, "geocode"))


def run_panel(spark: SparkSession, base: str, csv_export: bool = True,
              metrics: dict | None = None, sort_export: bool = True) -> DataFrame:
    """Geocoded intervals x years + yearly facts; ``;``-separated CSV
    export as a directory written in parallel. The export is ordered by
    (tin, year) like the source's single file, but as a range-partitioned
    sort: part files are sorted and follow each other in key order."""
    geo = spark.read.parquet(_p(base, "geocode"))
    facts = []
    for ds in ("revexp", "empl"):
        path = _p(base, "aggregate", ds)
        if path_exists(spark, path):
            facts.append(spark.read.parquet(path))
    panel = panelize(geo, facts)
    m = metrics if metrics is not None else {}
    _counted(panel, "panel", m).write.mode("overwrite").parquet(_p(base, "panel"))
    if csv_export:
        out = spark.read.parquet(_p(base, "panel"))
        if sort_export:
            out = out.orderBy("tin", "year")
        write_csv(out, _p(base, "panel-csv"), sep=";")
    return spark.read.parquet(_p(base, "panel"))


def run_all(spark: SparkSession, base: str, dims: Dimensions,
            codes: Sequence[str] | None = None, metrics: dict | None = None) -> DataFrame:
    """Extract -> aggregate -> geocode -> panelize. Pass a dict as
    ``metrics`` to collect per-stage row counts (``report(metrics)``)."""
    run_extract(spark, base, dims, codes, metrics)
    run_aggregate(spark, base, metrics)
    run_geocode(spark, base, dims, metrics)
    return run_panel(spark, base, metrics=metrics)
