"""Operators for training corpora: filters, deduplication, joins, tokens and packing.

Each module is one operator with its own interface; ``queries`` binds them to the
test tables and ``components`` links pairs into groups.
"""

import sys

from pyspark import cloudpickle

# Functions go to the tasks by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
