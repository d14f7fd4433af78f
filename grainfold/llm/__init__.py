"""Operators of a training-data pipeline: counting, deduplication, decontamination, scoring, mixing and search.

Each operator takes DataFrames and gives a DataFrame. Nothing else in the library imports
this package. Functions that run in Python workers travel with the job.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
