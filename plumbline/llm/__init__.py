"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# what runs in tasks travels with them, so that workers need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
