"""Training-data operators: mixing, deduplication, filters, classifiers, extraction."""

import sys

from pyspark import cloudpickle

# Tasks get the helpers of this folder with their functions, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
