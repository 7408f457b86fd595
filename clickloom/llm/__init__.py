"""Operators of a training-data pipeline; nothing else in the package imports them.

Their functions travel to the executors by value, so that a session needs no
copy of the package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
