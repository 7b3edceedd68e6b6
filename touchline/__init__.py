"""Sports-style wrangling and statistics as Spark DataFrame operators."""
import sys

from pyspark import cloudpickle

# Helpers of Python tasks travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
