"""Operators for preparing training text at scale, with their queries and oracles.

Functions that run on executors are pickled by value, so a session whose
executors don't have this package on their path can run them.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
