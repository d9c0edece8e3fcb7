"""Operators on text for training data; nothing outside this package imports it.

The functions that run in Python workers travel with the job by value, so the
executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
