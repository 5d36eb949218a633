"""Exact on-chain analytics expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

# Row helpers travel inside the serialized functions, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
