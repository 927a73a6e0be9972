"""tallybrook: a layered retail warehouse on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with their code, so the
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
