"""Operators of a training-data pipeline over the text tables; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# functions sent to executors carry their code along, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
