"""Operators for training-data corpora. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the task, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
