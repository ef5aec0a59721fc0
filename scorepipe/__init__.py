"""Tabular risk scoring on Spark: every step is a DataFrame -> DataFrame operator."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
