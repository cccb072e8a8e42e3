"""Operators for preparing training data: near duplicates, filters, scans, tokens, packing, search."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, which need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
