"""Corpus operators for training-data pipelines.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds its
queries (``basketry.llm.registry``) only where it can be imported.

Functions that run inside tasks are sent to the executors by value, so nothing has to
be installed or shipped there besides numpy and pyarrow.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
