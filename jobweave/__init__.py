"""Candidate, posting and labour-market analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python tasks travel with the task, so that executors need
# no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
