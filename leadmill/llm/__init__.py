"""Operators for preparing training data, with their queries; nothing else in the library uses them."""

import sys

from pyspark import cloudpickle

# Python workers get these modules with the task, so they need not be installed where tasks run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
