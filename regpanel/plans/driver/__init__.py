"""Driver-table adapters: each query maps the TPC-H-ish driver tables onto the
registry data model and runs the library operators over the *whole* tables.

Every query has a DuckDB twin in ``ORACLE_SQL`` with the same column names.
Dates leave as ISO text and integers as BIGINT so both engines hand back
identical types; the library itself keeps DateType / IntegerType.
"""

from . import files, intervals, keys, matching, quality, registry, scenarios, sources  # noqa: F401  (register)
from . import geocoding  # noqa: F401,E402  (registers last: it builds on the registry queries)
from .common import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
