"""Lakehouse data operations expressed as Spark DataFrames and jobs."""

import sys

from pyspark import cloudpickle

from lakewright.errors import LakeError
from lakewright.lake import Lake

# Functions that run in Python workers travel with the job, so executors need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Lake", "LakeError"]
