"""Operators for training data, their queries and the helpers they share.

Functions that run in Python workers go there by value, so that executors need no copy
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
