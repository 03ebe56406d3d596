"""Operators for preparing training data. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to executors by value, so that a cluster needs no
# installation of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
