"""Operators of a training-data pipeline. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions reach the Python workers by value, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
