"""Operators of a training-data pipeline, as Spark jobs.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are pickled by value. Objects that are broadcast (op5's model,
op9's tree) are pickled by name: ship the package to the executors
(``--py-files`` or their path) for those.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
