"""Operators for preparing text corpora: one removable part, which nothing else in the library imports."""

import sys

from pyspark import cloudpickle

# What tasks run is shipped to them by value: the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
