"""Operators for large text corpora, one module each, and their queries.

Functions that run in Python tasks are sent by value, so executors need
nothing of this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
