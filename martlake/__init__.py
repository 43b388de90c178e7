"""martlake: retail-chain analytics as Spark DataFrame operators.

Sub-packages
------------
sources    -- loading the retail tables (adapter over the test parquet) and request tables
functions  -- column-expression helpers (dates, Oracle-compatible rounding rules)
operators  -- queries, reports, validation rules and constraint checks (pure DataFrame -> DataFrame)
plans      -- batch jobs that apply request tables to snapshots, and the ordered ledger fold
streaming  -- Structured Streaming versions of the ledger, low-stock, de-duplication and pickup jobs
"""

import sys as _sys

from martlake.session import build_session, checkpoint_dir  # noqa: F401

# The functions that run on executors (ordered folds, streaming state functions) are shipped
# by value, so executors need no copy of this package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pickler without the registry
    pass
