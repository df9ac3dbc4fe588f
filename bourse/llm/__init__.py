"""Operators that prepare training data: personal data, nearest neighbours,
quality, toxicity, licences, repeated lines, benchmark leaks, sharding, near
copies, packing, web archives, conversation prefixes and periodic runs.  Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with the tasks that need
# them, so a cluster needs no copy of the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
