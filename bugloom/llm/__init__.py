"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it.  Functions that run on executors are
pickled by value, so executors need numpy, pyarrow and the tokenizer libraries
but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
