"""Operators for building training corpora. Nothing else in the library imports this package.

Functions that run in Python workers are shipped by value, so a worker needs
only the third-party libraries, not this package, on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
