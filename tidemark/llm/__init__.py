"""Training-data operators: one module per operator, plus their registered queries.

Nothing outside this folder imports it. ``registry`` lists the queries; every
operator module keeps a general interface (column names and parameters are
arguments) and the thin ``opN_*`` query applies it to its whole table.

Functions that run in Python workers are pickled by value, so executors need no
copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
