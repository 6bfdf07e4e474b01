"""Operators for preparing training text: language identification, URL lists,
toxicity, mixing, deduplication, sharding, extraction, decontamination, counts.

Nothing else in the library imports this package. Its functions are pickled
by value, so tasks need no copy of the package on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
