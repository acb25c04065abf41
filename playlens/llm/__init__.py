"""Operators of a training-data pipeline over the ``documents`` tables.

Functions that run on executors are pickled by value, so executors need numpy,
pyarrow and zstandard but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
