"""Operators for building training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the Python workers with the job, so executors need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
