"""Extract a dataset from zipped XML dumps into typed rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import broadcast_if_bounded
from ..operators.keys import expand_codes
from ..sources.archive import list_archives, list_members, new_archives, read_members
from ..sources.schemas import (DOCUMENT_TAG, ELEMENTS, INPUT_DATE_FORMAT, ROOT_ATTRIBUTES,
                               SCHEMAS)
from ..sources.xml import CORRUPT, apply_types, parse_files_once


@dataclass
class Extracted:
    parsed: DataFrame        # documents and quarantined members, by ``_status``
    archives: DataFrame      # archives read in this run (for the manifest)

    @property
    def documents(self) -> DataFrame:
        """Typed rows, one per document element."""
        return self.parsed.filter(F.col("_status") == "ok").drop("_status", CORRUPT)

    @property
    def quarantine(self) -> DataFrame:
        """Members that did not parse, with their text."""
        return (self.parsed.filter(F.col("_status") == "quarantine")
                    .select("archive", "member", CORRUPT))


def extract(spark: SparkSession, in_dir: str, dataset: str,
            classifier: DataFrame | None = None, codes: Sequence[str] | None = None,
            manifest_path: str | None = None, elements: dict | None = None,
            glob: str = "*.zip", num_partitions: int | None = None,
            archive_names: Sequence[str] | None = None,
            member_slice: tuple[int | None, int | None, int | None] | None = None
            ) -> Extracted:
    """S4 -> S3 -> S2 (+P1, P2, S5) -> types, and P3 for the registry.

    Provenance (file id, document count) is kept for the registry only, as
    in the source pipeline. Archives already in the manifest are skipped;
    call ``sources.archive.record_ingested(result.archives, manifest_path)``
    after the documents were written. ``archive_names`` restricts the run to
    a hand-picked list of archives (the validation extract, S12, reads seven
    yearly snapshots with ``elements=VALIDATION_ELEMENTS``).
    ``member_slice=(start, stop, step)`` reads that slice of each archive's
    XML members (in archive order), e.g. for a trial run.
    """
    elements = elements or ELEMENTS[dataset]
    archives = new_archives(list_archives(spark, in_dir, glob), manifest_path)
    if archive_names is not None:
        archives = archives.filter(F.col("name").isin(list(archive_names)))
    start, stop, step = member_slice or (None, None, None)
    members = read_members(list_members(archives, start=start, stop=stop, step=step),
                           num_partitions)
    root = ROOT_ATTRIBUTES if dataset == "smb" else None
    parsed = parse_files_once(members, elements, doc_tag=DOCUMENT_TAG, root_attrs=root,
                              keep=("archive", "member"))
    if dataset in SCHEMAS and elements is ELEMENTS.get(dataset):
        parsed = apply_types(parsed, SCHEMAS[dataset], INPUT_DATE_FORMAT,
                             keep=("archive", "member", CORRUPT, "_status"))
    if dataset == "smb" and classifier is not None and codes:
        # One pass: a left join with the (broadcast) code set keeps the
        # quarantine rows, instead of a union of two filtered branches.
        wanted = broadcast_if_bounded(
            expand_codes(classifier, codes).withColumnRenamed("code", "activity_code_main")
            .withColumn("_hit", F.lit(True)))
        parsed = (parsed.join(wanted, "activity_code_main", "left")
                        .filter((F.col("_status") == "quarantine") | F.col("_hit").isNotNull())
                        .drop("_hit"))
    return Extracted(parsed, archives)

