"""Operators for preparing training data. Nothing else in the package imports this one.

Functions that run in tasks are sent to the executors with the tasks, so that a cluster needs only the
libraries they use, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
