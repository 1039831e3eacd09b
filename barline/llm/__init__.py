"""Training-data operators: extraction, rules, models, joins, search, packing.

Functions that run in Python workers are pickled by value, so executors need
numpy and Arrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
