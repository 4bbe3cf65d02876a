"""regpanel: registry snapshots and yearly filings -> georeferenced
entity-by-year panels, as Spark DataFrame operators.

Subpackages: ``operators`` (interval, key, dedupe, matching, region,
quality, reshape and skew-proof ordered-scan operators), ``sources`` (zip /
XML / CSV sources and sinks, dimension loaders), ``functions`` (column
expressions), ``plans`` (the composite stages and the pipeline),
``streaming`` (Structured Streaming forms of ingest and the state hull).
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Python tasks (``mapInPandas``) reference helpers of this package.
    Serialise the package's functions by value so that executors need not
    have ``regpanel`` importable (it travels with each task's closure)."""
    try:
        import sys

        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # very old cloudpickle: ship with --py-files instead
        pass


_ship_by_value()
