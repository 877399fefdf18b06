"""linkmill: crawl-data processing as Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions travel to the executors with their code, so the cluster needs
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
