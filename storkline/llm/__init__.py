"""Operators for preparing large training corpora.

Nothing else in the library imports this subpackage. Its functions run inside Python workers, which
need not have the repository on their path, so they travel by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
