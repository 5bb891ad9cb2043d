"""Text and event analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Stream processors and batch functions travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
