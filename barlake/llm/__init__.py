"""Operators of a training-data pipeline, on Spark.

Thirteen operators over ``documents``, ``benchmark``, ``embeddings``, ``labels`` and
``pages``; ``registry`` holds their registered queries.  Nothing else in the
library imports this package.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
