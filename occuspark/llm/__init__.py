"""Training-data operators: quality, toxicity, near duplicates, mixing, packing, search and extraction."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
