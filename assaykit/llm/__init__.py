"""Operators for training-data pipelines: quality, duplicates, contamination, packing and more.

Their functions travel to the executors with the job, so the executors need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
