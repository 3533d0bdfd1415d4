"""Operators of a training-data pipeline.

Nothing else in the package imports from here. Every operator takes and
returns DataFrames; intermediate tables live in the shared folder named by
``spark.checkpoint.dir``.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
