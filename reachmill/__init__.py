"""reachmill: accessibility matrices and their derivations on Spark."""

import sys

from pyspark import cloudpickle

# What runs in Python workers is pickled by value, so executors need no copy of this repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
