"""Operators for preparing text corpora; nothing else in the library depends on them.

Their functions are shipped to the executors by value, so only the driver needs this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
