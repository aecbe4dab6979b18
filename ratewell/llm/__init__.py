"""Operators for preparing training text at scale; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the plan, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
