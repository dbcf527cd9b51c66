"""Operators for large-scale training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# The functions that run in tasks travel with the job, so executors need no copy
# of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
