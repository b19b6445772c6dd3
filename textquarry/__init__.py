"""Document-to-chunk analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Arrow functions travel to the executors inside the plan, so a cluster needs
# no separate installation of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
