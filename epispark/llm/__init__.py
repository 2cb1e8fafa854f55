"""Operators for large training-data pipelines (text tables), one module per operator."""

import sys

from pyspark import cloudpickle

# functions that run inside tasks travel with the job: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
