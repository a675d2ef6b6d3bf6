"""Operators for preparing text for training. Nothing else in the package imports them.

Functions that run on executors travel with their code, so that executors need the
libraries these import but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
