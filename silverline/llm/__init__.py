"""Operators for preparing text corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
