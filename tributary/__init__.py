"""Loader and reporting engine for periodic relational extracts, on Spark."""

import sys

from pyspark import cloudpickle

# Tasks receive the package's functions with the job, so executors need no
# copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
