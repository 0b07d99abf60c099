"""Operators for preparing training text. Nothing outside this package imports it.

Functions of this package travel to the executors by value, so these need not
have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
