"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors with the jobs that use them, so nothing has to be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
