"""Operators for preparing training data; nothing else in the library imports this package.

Its functions travel to the executors by value, so that they needn't have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
