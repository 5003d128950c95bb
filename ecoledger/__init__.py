"""Ecosystem collapse-risk assessment as Spark jobs.

Public functions take and return DataFrames (or Columns). Those that run a job
of their own, to settle a small table, say so.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so the package need
# not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
