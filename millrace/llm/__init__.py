"""Operators for training data: deduplication, filtering, scoring, formatting, search."""

import sys

from pyspark import cloudpickle

# Task code travels with its task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
