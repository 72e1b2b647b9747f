"""tickwise: keyed price-tick and news analytics on Spark DataFrames.

Subpackages:
  sources    -- explicit-schema readers/writers (JSON landing, vendor payloads, RSS XML, Kafka)
  functions  -- column-expression helpers (rounding, ids, formats, array maths)
  operators  -- keyed relational operators (stats, snapshots, series windows, models, views)
  plans      -- composed batch jobs (analysis, forecast, monitoring)
  streaming  -- Structured Streaming ingest and snapshot maintenance
"""

__version__ = "0.1.0"

# Python functions that run inside Spark tasks (pandas helpers) are serialized by value, so
# executors need no installed copy of this package (no --py-files, any working directory).
try:
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship the package with --py-files
    pass
