"""Operators of a large-scale training-data pipeline, each by one stated method."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
