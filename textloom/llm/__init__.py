"""Operators of a training-data pipeline, with their queries and oracle SQL.

Nothing outside this subpackage imports it. Its functions are pickled by value,
and broadcast objects travel with their classes (``common.Shared``), so executors
need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
