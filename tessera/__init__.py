"""tessera: document analytics on Spark DataFrames.

Operators are plain ``DataFrame -> DataFrame`` functions (``tessera.operators``), Column functions
(``tessera.functions``), sources and sinks (``tessera.sources``), the incremental ingest stream (``tessera.streaming``)
and the registered query plans over the test tables (``tessera.plans``).
"""

__version__ = "0.1.0"
