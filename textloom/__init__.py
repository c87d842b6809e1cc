"""textloom: Spark-native operators for labelled text corpora.

Public surface: plain functions ``op(df, ...) -> DataFrame`` (in
``textloom.operators`` and ``textloom.plans``) and column expressions
``expr(col) -> Column`` (in ``textloom.functions``).
"""

import sys

from pyspark import cloudpickle

from textloom.session import get_session, shared_dir, work_path

# Functions run on executors are pickled by value: those need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session", "shared_dir", "work_path"]
