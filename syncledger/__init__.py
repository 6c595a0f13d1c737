"""syncledger: reconcile large file inventories with Spark DataFrames.

Inputs are DataFrames (local listing, remote listing, archive catalog,
change feed, exclusions, roots); outputs are decisions, plans, new catalog
snapshots and reports.
"""

import sys as _sys

__version__ = "0.1.0"

# The few functions that run in Python workers (mapInPandas bodies) are
# shipped by value, so executors do not need the package installed. Shipping
# it with --py-files works as well.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: rely on --py-files
    pass
