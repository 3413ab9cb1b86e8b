"""Operators for large-scale training-data pipelines (quality, dedup, packing, ...).

Each module holds one operator with a general interface; ``catalog`` registers
one query per operator. Nothing outside this folder imports it, apart from the
repository's entry point and ``corpus_pipeline.py``.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so executors need not
# have the repository installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
