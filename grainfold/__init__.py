"""Data operators of analytics and machine-learning jobs as Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
