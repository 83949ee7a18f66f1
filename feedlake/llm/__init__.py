"""Operators for preparing training data at scale: deduplication, search, scoring, packing.

Functions that run in Python workers travel with the plan, by value, so that executors need
only the libraries and no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
