"""Noticeloom: procurement-notice analytics on Spark DataFrames.

Functions of this package that run in Python workers are pickled by value, so an executor needs no copy of the package
on its own path; nothing has to be shipped with ``--py-files``.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
