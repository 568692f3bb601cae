"""Operators of a large-scale training-data pipeline.

Their task code travels to the executors by value, so the package needs no
installation there."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
