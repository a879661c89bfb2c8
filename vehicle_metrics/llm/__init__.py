"""Operators for preparing training text, one module per operator.

The rest of the library never imports this package. Functions that run in
Python workers are pickled by value, so executors need only the third-party
packages (numpy, pyarrow, ...), not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
