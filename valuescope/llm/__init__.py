"""Operators of a training-data pipeline over text corpora (one module each)."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
