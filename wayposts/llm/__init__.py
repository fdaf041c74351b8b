"""Operators for preparing training data: mixing, filtering, deduplicating, packing, scoring.

Each module holds one operator with a general interface; ``queries`` applies them to the whole
test tables. Functions that run in Python workers are shipped by value, so that executors need
this package nowhere on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
