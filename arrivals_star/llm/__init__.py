"""Operators for large text corpora. Nothing else in the library imports this package.

Functions that run in Python workers travel with their task, so executors need no copy of the
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
