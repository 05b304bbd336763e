"""Operators for building training corpora: one module per operator, each a
``DataFrame -> DataFrame`` function, plus the registered queries.

The functions that run inside tasks travel with the plan (pickled by value),
so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
