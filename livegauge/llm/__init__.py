"""Operators for preparing training data: one module per operator, their queries in ``queries``."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
