"""Operators for building training corpora; nothing else in the library imports this.

Functions and classes of this subpackage travel to the executors by value, so the package need not
be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
