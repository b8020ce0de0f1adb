"""Operators of a training-data pipeline, on the documents, pages, benchmark and labels tables.

Nothing outside this subpackage imports it. ``queries.QUERIES`` and
``queries.ORACLE`` hold the registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Tasks carry this subpackage's functions by value: executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
