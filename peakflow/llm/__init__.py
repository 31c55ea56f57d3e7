"""Operators of a training-data pipeline over documents, pages and labels.

Functions that run inside tasks travel to the executors by value, so a cluster needs no copy of this
package on its machines."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
