"""Training-data operators: near-duplicate search, tokenising, packing, language labels, extraction.

Nothing else in the library imports this subpackage.  ``plans`` holds the registered queries (``QUERIES``) and their
DuckDB oracle SQL (``ORACLES``).
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to executors by value, so tasks need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
