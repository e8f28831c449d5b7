"""Operators for preparing language-model training data (documents, pages, labels, benchmark).

Task functions travel by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
