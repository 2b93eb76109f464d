"""Operators for large training-data pipelines.

The functions that Spark ships to its Python workers are pickled by value, so executors need
no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
