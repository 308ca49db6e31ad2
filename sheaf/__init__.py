"""sheaf — document pipelines as Spark jobs.

- ``sources``: scans and sinks (config documents, wiki dumps, sitemaps,
  request files, staging, the point store, XML files).
- ``functions``: column expressions (JSON payloads, dates, names, text).
- ``operators``: DataFrame → DataFrame steps (registry, wiki, web,
  documents, load, summaries, digest, search, model hooks).
- ``streaming``: continuous intake and windowed counts.
- ``plans``: size-checked joins, the test-table views, the registered
  queries and their DuckDB twins.
"""

__version__ = "0.1.0"

# Python code that runs inside tasks (UDTF, Arrow UDF, grouped pandas hooks)
# is shipped by value, so executors need no installed copy of this package
# (the same effect as shipping it with --py-files).
import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
