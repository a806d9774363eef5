"""Column functions on scalars and texts; worker functions are pickled by value."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
