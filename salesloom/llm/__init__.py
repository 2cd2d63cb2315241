"""Operators for preparing training data; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Tasks get the Python functions they run by value, so workers need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
