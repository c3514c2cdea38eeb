"""Operators for preparing training text, their queries and their comparison SQL.

The functions that tasks run are sent by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
