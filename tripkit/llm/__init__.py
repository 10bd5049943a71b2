"""Operators of a training-data pipeline over document tables.

Each module holds one operator with its own general interface and the thin
``opN_<name>`` query derived from it. Ids are integers (a text id has to be
numbered first); other columns may have any type. Python that runs in tasks is shipped by
value, so executors need no install of this package.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(sys.modules[__name__])
