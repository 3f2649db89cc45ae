"""Operators that prepare training text for language models. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the task, so that a job needs no
# installed package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
