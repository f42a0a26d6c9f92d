"""Spark jobs for turning long-form laboratory results into a wide label table.

``sources``    scans, dictionary, cohort keys, tables
``functions``  column expressions
``operators``  DataFrame -> DataFrame steps
``sinks``      datasets, tables and their publication
``plans``      the five end-to-end jobs

Functions that run on executors travel with the job; executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
