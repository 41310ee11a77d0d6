"""shoplake: retail analytics on Spark DataFrames.

Every operator is a plain function ``DataFrame -> DataFrame`` built on the
DataFrame API, Spark SQL, MLlib and Structured Streaming.  Actions run
in ``shoplake.plans.jobs``, the ML fits, exact quantiles (one bracketing row) and streaming runs over tables;
all other functions only build plans.

Sub-packages
------------
``sources``    readers, writers and catalog helpers (snapshots, JDBC, Kafka,
               the TESTDATA bindings)
``functions``  column-level helpers (money sums, rounding, safe parsing) and
               the fixed label values
``operators``  cleaning, trade, user, product, basket, quality and ML operators
``streaming``  stream parsing and the windowed UV/PV and order totals
``plans``      job composition and the query registry
"""

__version__ = "0.1.0"
