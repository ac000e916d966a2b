"""Operators of a training-data pipeline over documents, pages and embeddings.

Functions that run in Python workers travel by value, so that a worker needs no
copy of this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
