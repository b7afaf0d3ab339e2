"""claimweave: a PySpark-native engine for claim evaluations and annotation datasets.

Every operator is a function ``DataFrame -> DataFrame`` that only builds a
logical plan; nothing runs until the caller asks for rows, except in the
iterative operators, which write their rounds to the shared stage folder.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in Python workers travel with the plan, so executors need
# no copy of this package on their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
