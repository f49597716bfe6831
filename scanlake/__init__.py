"""Scanned-document collections as Spark tables: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the tasks that call them, so the
# workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
