"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a worker needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
