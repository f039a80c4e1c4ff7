"""Operators for preparing training text, each in a module of its own."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
