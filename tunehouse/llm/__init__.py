"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# tasks get these modules' functions with the job, so executors need no installed copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
