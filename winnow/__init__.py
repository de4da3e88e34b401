"""Instruction-dataset preparation as ordinary Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# UDFs travel with the code they need, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
