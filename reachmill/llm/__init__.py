"""Training-data operators: deduplication, classifiers, personal data, tokens, packing, search.

Nothing outside this subpackage imports it.  ``queries`` holds the registered
queries, the other modules hold one operator each.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage are pickled by value, so executors need the
# third-party libraries only and not this repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
