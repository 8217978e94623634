"""Operators of a training-data pipeline over text tables."""

import sys

from pyspark import cloudpickle

# tasks get this code with their functions, also where the package is not installed on the workers
cloudpickle.register_pickle_by_value(sys.modules[__name__])
