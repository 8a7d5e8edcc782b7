"""Online learning and stream evaluation expressed as Spark DataFrame work."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry the package's code with them, so the package
# has to be installed (or on the path) at the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
