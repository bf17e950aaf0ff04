"""Operators that prepare training data for language models.

Functions of this package travel to the executors with the job, so the executors need no
copy of it, only the libraries it imports.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
