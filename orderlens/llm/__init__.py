"""Operators for large training corpora. Nothing else in the library imports this folder.

Functions that run in Python workers travel with their code, so executors need the libraries
these use (numpy, pyarrow, ...) but no installation of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
