"""Operators for preparing training data, each usable on its own, and their registered queries."""

import sys

from pyspark import cloudpickle

# Task functions of this subpackage travel with their job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
