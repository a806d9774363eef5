"""Operators for large training corpora.

Nothing outside this subpackage imports it.  Worker functions are pickled by
value, so a cluster needs no copy of the package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
