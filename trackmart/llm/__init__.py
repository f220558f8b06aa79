"""Operators for training-data pipelines over documents.

Nothing outside this package imports it. Functions that run in Python workers are
shipped with the task, so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
