"""Spark-native reconstruction and checking of long, multi-part document bundles."""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in Python workers travel by value: executors need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
