"""Operators for preparing training data: quality, deduplication, mixing, packing, search, URL filters, chat text.

Every operator takes DataFrames and returns a DataFrame.  The registered queries are in `queries`, their SQL in `sql`.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
