"""Scored text, anomaly findings and filtered alerts over post streams and tables.

Functions of this package travel to Python workers by value, so a session
works whether or not the package is installed on the executors.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
