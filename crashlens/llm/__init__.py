"""Operators of a training-data pipeline over the text, page and vector tables.

Nothing else in the library imports this subpackage. Task code is shipped by
value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
