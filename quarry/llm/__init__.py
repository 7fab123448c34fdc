"""Operators of a training-data pipeline, one module per operator.

Each operator takes DataFrames and returns DataFrames; ``queries.py`` holds
the registered queries, ``corpus_pipeline.py`` at the repository top chains
five of the operators.
"""

import sys

from pyspark import cloudpickle

# functions that run in executors travel whole, so a cluster needs no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
