"""Retrieval and ranking evaluation over tables of queries, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python functions travel to the tasks with their code, so the executors need
# no installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
