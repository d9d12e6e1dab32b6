"""contentrisk: Spark-native content-threat analytics.

Layers:
  sources/    scans of landed JSON, dictionary files, binary content, and the
              views over the driver's test tables
  functions/  dictionary model, column-expression builders (hashes, matching,
              HTML-to-text)
  operators/  DataFrame operators: ingest, enrichment, merges, statistics
  plans/      the analytics queries and the DuckDB oracle SQL
  streaming/  Structured Streaming enrichment with replay-safe upserts
"""

import sys as _sys

# Functions of this package that run inside tasks (the pandas UDFs of the Arrow
# matcher and the pluggable extractor) are pickled by value, so executors need
# no copy of the package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship the package with --py-files
    pass

from contentrisk.session import get_session, scratch_path  # noqa: E402,F401

__all__ = ["get_session", "scratch_path"]
