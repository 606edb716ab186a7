"""Operators for preparing training data. Nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Tasks get the functions themselves, so executors need no copy of this folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
