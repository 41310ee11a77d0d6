"""Operators for large training-text pipelines (archives, scans, dedup, scoring, mixing, token output).

Every operator takes DataFrames, keeps only the columns it names (extra columns
with clashing names are dropped before any work) and returns a DataFrame.
Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel whole, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
