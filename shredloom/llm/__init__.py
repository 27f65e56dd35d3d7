"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# What runs in tasks travels with the job, so executors need nothing of the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
