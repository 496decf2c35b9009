"""Drug-label safety analytics as PySpark DataFrame operators.

Functions sent to Python workers are pickled by value, so a cluster needs no
installed copy of this package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
