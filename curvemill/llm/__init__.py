"""Operators and queries for preparing training data; nothing else imports this package.

Functions that run in tasks travel with their code, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
