"""Offer analytics and data preparation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from pricelode.session import checkpointed, get_session, table

__all__ = ["checkpointed", "get_session", "table"]

# Functions that run in Python workers travel with the query, so that executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
