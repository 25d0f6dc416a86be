"""Operators for large-scale training-data preparation."""

import sys

from pyspark import cloudpickle

# Task functions travel with their helpers, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
