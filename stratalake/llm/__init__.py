"""Operators of a training-data pipeline.  Nothing else in the library imports them.

Functions of this package travel to executors by value, so the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
