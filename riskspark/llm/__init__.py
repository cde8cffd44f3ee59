"""Operators of a training-data pipeline: ten operators, their queries and check SQL."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with the tasks that use them,
# so a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
