"""Log-window analytics on Spark."""

import sys

from pyspark import cloudpickle

# Executors need no installed copy of the package: its functions travel with the jobs that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
