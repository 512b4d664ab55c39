"""Operators for preparing text corpora for language-model training, as Spark jobs.

Functions that run in Python workers travel with their tasks, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
