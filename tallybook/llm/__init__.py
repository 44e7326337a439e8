"""Operators for preparing language-model training data; nothing else in the package imports them.

Their functions travel to the executors by value, so these need the libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
