"""Operators for training-data pipelines.

Functions of this subpackage travel to the executors by value, so only the driver needs it on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
