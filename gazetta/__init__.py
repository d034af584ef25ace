"""gazetta: temporal entity resolution and lineage products as Spark plans."""

import sys

from pyspark import cloudpickle

# functions of this package travel to executors by value, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
