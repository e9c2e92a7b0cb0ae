"""Time-series preparation, forecasting and evaluation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from seriesprep.spec import SeriesSpec, safe_name, safe_names

__all__ = ["SeriesSpec", "safe_name", "safe_names"]

# Functions that run in Python workers travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
