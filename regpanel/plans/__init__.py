"""Composite stages (C1-C9) built from the operators."""

from .extract import Extracted, extract
from .geocode import geocode
from .panel import panelize, yearly_panel
from .pipeline import Dimensions, read_quarantine, read_stage, report, run_all
from .registry import aggregate_facts, aggregate_registry, legal_entities
from .validation import (compare, prepare_statistics, registry_by_region, registry_counts,
                         run_validation, summaries)

__all__ = [
    "Extracted", "extract", "geocode", "panelize", "yearly_panel",
    "Dimensions", "read_quarantine", "read_stage", "report", "run_all",
    "aggregate_facts", "aggregate_registry", "legal_entities",
    "compare", "prepare_statistics", "registry_by_region", "registry_counts",
    "run_validation", "summaries",
]
