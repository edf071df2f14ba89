"""Operators for preparing text corpora; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions of this package travel with the task, so that executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
