"""Training-data operators: deduplication, sharding, scoring, PII, search,
mixing, tokenising.  Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with their code, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
