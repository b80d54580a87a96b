"""Operators for preparing training data; nothing else in the library imports them.

Their functions travel to the executors by value, so that these need not have the library installed."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
