"""Operators for preparing training data: one module each, queries in ``queries``."""

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions by value: executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
