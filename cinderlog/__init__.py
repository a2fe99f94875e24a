"""Log analytics on Spark: lines and records in, typed events, an index to query."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run inside tasks travel with the task, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
