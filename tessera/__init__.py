"""Experimentation, uplift, pricing and matching analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that a job also runs where
# the package is not installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
