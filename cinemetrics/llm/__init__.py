"""Operators for preparing training text at scale, one module per operator.

Functions that run inside Python workers are pickled by value, so the executors need the
third-party libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
