"""Risk analysis of mentions of a subject, written as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Tasks carry the code of their functions, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
