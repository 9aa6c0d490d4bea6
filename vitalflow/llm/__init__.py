"""Operators for building training corpora.

Each module holds one operator. Functions that run in Spark's Python workers are pickled by
value, so that workers need no import path to this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
