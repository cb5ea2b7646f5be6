"""Training-data operators: filtering, deduplication, decontamination, mixing, encoding and sharding of text tables."""

import sys

from pyspark import cloudpickle

#: Functions that run in tasks travel by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
