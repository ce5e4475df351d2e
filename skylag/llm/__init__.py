"""Operators for training-data pipelines over documents, pages and vectors."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
