"""Operators for training-data pipelines, each on Spark DataFrames.

Python functions of this subpackage travel to the executors by value, so no
executor needs the package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
