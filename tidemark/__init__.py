"""Event analytics as PySpark DataFrame and Structured Streaming operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with their code, so executors do not
# need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
