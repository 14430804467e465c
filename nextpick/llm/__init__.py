"""Operators for training data at scale; nothing else in the library imports this subpackage.

Functions that Spark ships to Python workers travel by value, so that executors need not have
this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
