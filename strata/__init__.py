"""strata: medallion operations analytics as Spark DataFrame jobs.

Every public function is ``DataFrame -> DataFrame`` (or returns a ``Column``)
so jobs compose with ``df.transform(...)`` and Catalyst sees one plan.
"""

import sys as _sys

__all__ = ["session"]

# Python workers (pandas UDFs, mapInPandas, the workbook data source) receive the
# package's functions by value, so executors need no copy of this package on
# their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: the package must then be on the workers' path
    pass
