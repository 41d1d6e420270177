"""Exact hierarchical clustering and run-log analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Ship the small task helpers with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
