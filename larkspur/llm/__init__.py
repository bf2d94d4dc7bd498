"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions that run in Spark's Python workers travel with their code, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
