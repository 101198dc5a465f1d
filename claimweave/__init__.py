"""Evidence analytics on Spark: bronze snapshots, silver cleaning, gold agreement scores."""

import sys

from pyspark import cloudpickle

# Python functions travel inside their tasks, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
