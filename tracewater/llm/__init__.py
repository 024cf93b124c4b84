"""Operators for training-data pipelines: de-duplication, scoring, search, mixing, formatting, tokens.

Nothing else in the library imports this package. Its queries on the test
tables are in ``tracewater.llm.queries``.
"""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors by value, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
