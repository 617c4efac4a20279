"""Operators of a training-data pipeline over ``documents``, ``labels`` and ``embeddings``.

Each module holds one operator with its own interface; ``queries`` registers the thin
``opN_<name>`` queries. Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the tasks by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
