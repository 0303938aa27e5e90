"""Operators for building language-model training data.

Functions of this package travel to the executors by value, so workers need
the installed libraries only, not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
