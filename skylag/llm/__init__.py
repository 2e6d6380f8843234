"""Operators for preparing training text, and their queries."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that workers need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
