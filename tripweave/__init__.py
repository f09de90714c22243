"""tripweave: batch, streaming and serving analytics over trip records, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from tripweave.session import build_session

# Functions of the package travel to the executors with the job, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
