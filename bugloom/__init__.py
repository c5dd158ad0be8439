"""A Spark-first engine for learning from historical defects.

Functions that run on executors are pickled by value, so executors need the libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
