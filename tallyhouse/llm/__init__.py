"""Operators of a training-data pipeline, each a Spark job over whole tables.

Functions that run in Python workers are shipped by value, so a cluster needs
no copy of this package on its executors.
"""

from pyspark import cloudpickle as _cloudpickle

import tallyhouse.llm as _package

_cloudpickle.register_pickle_by_value(_package)
