"""fabline: production-line sensor analytics on Spark DataFrames.

Every public operator takes and returns ``pyspark.sql.DataFrame``; thresholds
are keyword parameters whose defaults are the production line's settings.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Functions shipped to Python workers (pandas folds, kNN blocks) are pickled
# by value, so executors do not need this package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
