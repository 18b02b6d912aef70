"""Time features, point-in-time lookups, scoring and monitoring as plain Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code with them: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
