"""Tidemark: event-stream analytics written with Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

# Python workers get the package's functions with the task, so they need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
