"""Entity-level risk features and model evaluation as Spark jobs.

The few functions that run in Python workers are shipped with the job, so
executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
