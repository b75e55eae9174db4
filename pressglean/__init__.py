"""Spark-first analytics for dated collections of links, pages and scans."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
