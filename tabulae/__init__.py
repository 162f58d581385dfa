"""tabulae — public-records preparation on Spark.

Raw delimited government files in, clean query-ready parquet out, built
entirely from the DataFrame API so Catalyst plans every step.
"""

__version__ = "0.1.0"

# Functions this package hands to Python workers (mapInPandas) are shipped
# by value, so executors need no installed copy of the package.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
