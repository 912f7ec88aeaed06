"""Operators of a training-data pipeline over text corpora.

Nothing else in the library imports this subpackage.  Functions that run on
executors are shipped by value, so workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules["pingloom"])
