"""Spark-native analytics over recorded multimodal sessions."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions with the task, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
