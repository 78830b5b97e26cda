"""Operators that prepare a corpus for language-model training.

Functions that run in Python workers are sent to them whole, so executors need no copy of this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
