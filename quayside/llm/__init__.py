"""Operators for large-scale training-data pipelines.

Ten operators (token output, source mixing, language ID, near and exact
dedup, repeated-passage removal, sharding, HTML extraction, packing, exact
top-k search) and the queries that apply them to whole tables
(``quayside.llm.queries``).  Nothing else in the library imports this
subpackage.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this subpackage travel to the Python workers by value, so a
# worker needs no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
